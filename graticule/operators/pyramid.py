"""Maps from kept sums: bins of doubling widths, written once per period, read instead of the data."""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.bins import AxisStats, bin_width, read_axes, target_cells
from graticule.functions.calendar import as_time, bucket, bucket_end, check_frequency, needs_origin
from graticule.functions.columns import col, require, type_of, typed

# What is kept of a variable in a bin, and how bins are merged.
KEPT = {"sum": F.sum, "n": F.sum, "min": F.min, "max": F.max}
PERIOD = "'p'yyyyMMddHHmmss"  # names of periods sort as their starts


@dataclass(frozen=True)
class PyramidSpec:
    """What a pyramid holds; kept beside its tables."""

    variables: list[str]
    y: str
    x: str
    y_width: float
    x_width: float
    levels: int
    time: str | None = None
    freq: str = "MS"
    keys: list[str] = field(default_factory=list)
    key_types: list[str] = field(default_factory=list)


class Pyramid:
    """Sums, counts and ends of variables per bin, at widths that double from level to level.

    Level 0 is read off the data, every further level off the one below: bins are anchored at
    0, so a bin of twice the width is exactly two of its bins. Tables are partitioned by level and
    period (the bucket of ``freq`` of ``time``): a map reads one level and the periods it
    wants. Other dimensions to filter or group by are kept as ``keys``.

    What new data invalidate is a period: :meth:`refresh` writes the named periods anew and leaves
    the others. A range of times that cuts a period takes the whole periods from here and
    only the cut ones from the data.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.spec = PyramidSpec(**json.loads(spark.read.text(os.path.join(path, "about")).first()[0]))

    @classmethod
    def build(
        cls,
        df: DataFrame,
        path: str,
        variables: Sequence[str],
        target: str | int = "high",
        levels: int = 5,
        x: str = "lon",
        y: str = "lat",
        time: str | None = None,
        freq: str = "MS",
        keys: Sequence[str] = (),
        axes: dict[str, AxisStats] | None = None,
        widths: tuple[float, float] | None = None,
    ) -> Pyramid:
        """Write all levels; the finest has the bins of a map of ``target`` cells, or of the given widths (y, x).

        A grid with fewer cells than that is binned by the mean distance of its labels.
        """
        require(df, [*variables, x, y, *keys, *([time] if time else [])])
        if levels < 1:
            raise ValueError("levels must be at least 1")
        if time:
            check_frequency(freq)
            if needs_origin(freq) or freq.startswith("W"):
                raise ValueError(f"{freq} is no period here. Known: min, h, D (dividing a day), MS, QS, YS")
        if widths is None:
            axes = axes or read_axes(df, [y, x])
            cells = axes[y].size * axes[x].size
            step = {n: (axes[n].max - axes[n].min) / max(axes[n].size - 1, 1) or 1.0 for n in (y, x)}
            widths = tuple(bin_width(axes[n], cells, target_cells(target)) or step[n] for n in (y, x))
        if min(widths) <= 0:
            raise ValueError("widths must be positive")
        spec = PyramidSpec(list(variables), y, x, float(widths[0]), float(widths[1]), levels, time, freq, list(keys), [type_of(df, k).json() for k in keys])
        about = df.sparkSession.range(1).select(F.lit(json.dumps(asdict(spec))).alias("value"))
        about.coalesce(1).write.mode("overwrite").text(os.path.join(path, "about"))
        out = cls(df.sparkSession, path)
        out.refresh(df)
        return out

    def _name(self, start: Column) -> Column:
        return F.date_format(start, PERIOD)

    def _sums(self, df: DataFrame) -> DataFrame:
        """Level 0 of the given rows; rows without coordinates, key or time have no bin."""
        s = self.spec
        period = self._name(bucket(as_time(df, s.time), s.freq)) if s.time else F.lit("pall")
        bins = [F.floor(col(n).cast("double") / F.lit(w)).alias(b) for n, w, b in ((s.y, s.y_width, "_y"), (s.x, s.x_width, "_x"))]
        rows = df.select(*[col(k) for k in s.keys], period.alias("period"), *bins, *[col(v).cast("double").alias(v) for v in s.variables])
        first = {"sum": F.sum, "n": F.count, "min": F.min, "max": F.max}
        sums = [f(col(v)).alias(f"{v}_{kind}") for v in s.variables for kind, f in first.items()]
        return rows.dropna(subset=["period", "_y", "_x"]).groupBy(*[col(k) for k in s.keys], "period", "_y", "_x").agg(*sums)

    def _merged(self, sums: DataFrame, keys: Sequence[str]) -> DataFrame:
        return sums.groupBy(*[col(k) for k in keys]).agg(*[f(col(f"{v}_{kind}")).alias(f"{v}_{kind}") for v in self.spec.variables for kind, f in KEPT.items()])

    def _coarser(self, sums: DataFrame, by: int) -> DataFrame:
        """The same sums ``by`` levels up."""
        up = sums.withColumns({b: F.shiftright(b, by) for b in ("_y", "_x")})
        return self._merged(up, [*self.spec.keys, "period", "_y", "_x"])

    def _table(self, level: int) -> DataFrame:
        if not 0 <= level < self.spec.levels:
            raise ValueError(f"Levels are 0 to {self.spec.levels - 1}")
        s = self.spec
        fields = [T.StructField(k, T._parse_datatype_json_string(t)) for k, t in zip(s.keys, s.key_types)]
        fields += [T.StructField(b, T.LongType()) for b in ("_y", "_x")]
        fields += [T.StructField(f"{v}_{kind}", T.LongType() if kind == "n" else T.DoubleType()) for v in s.variables for kind in KEPT]
        # empty periods hold one row without a bin
        rows = self.spark.read.schema(T.StructType([*fields, T.StructField("period", T.StringType())])).parquet(self._place(level))
        return rows.filter("_y IS NOT NULL")

    def _place(self, level: int) -> str:
        return os.path.join(self.path, f"level-{level}")

    def refresh(self, df: DataFrame, times: Sequence[str] | None = None) -> None:
        """Write all periods, or those that hold one of the given times, anew from all rows of the data.

        Of the data only rows of these periods are read. Periods that have lost all rows become empty.
        """
        s, names = self.spec, None
        if times is not None:
            periods = self._periods(times)
            names = [r["name"] for r in periods]
            within = [(col(s.time) >= typed(type_of(df, s.time), r["a"])) & (col(s.time) < typed(type_of(df, s.time), r["b"])) for r in periods]
            df = df.filter(reduce(Column.__or__, within, F.lit(False)))
        sums = self._sums(df)
        for level in range(s.levels):
            if level:
                below = self._table(level - 1)
                sums = self._coarser(below if names is None else below.filter(F.col("period").isin(names)), 1)
            if names is None:
                sums.write.mode("overwrite").partitionBy("period").parquet(self._place(level))
            elif names:
                # one row per period, so that each is overwritten whatever it holds
                marks = self.spark.createDataFrame([(n,) for n in names], "period string")
                out = sums.unionByName(marks, allowMissingColumns=True)
                out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(self._place(level))

    def _periods(self, times: Sequence[str]) -> list:
        """Name, start and end of the periods that hold the times; no data are read."""
        if not self.spec.time:
            raise ValueError("This pyramid has no periods")
        given = self.spark.createDataFrame([(str(t),) for t in times], "t string").select(bucket(F.col("t").cast("timestamp_ntz"), self.spec.freq).alias("a"))
        return given.distinct().select(self._name(F.col("a")).alias("name"), "a", bucket_end(F.col("a"), self.spec.freq).alias("b")).collect()

    def sums(self, level: int = 0, start: str | None = None, end: str | None = None, df: DataFrame | None = None, where: Column | None = None) -> DataFrame:
        """Kept sums of a level, from ``start`` until before ``end``: keys, period, _y, _x and four columns per variable.

        ``where`` filters by the keys. Bounds inside a period need the data as ``df``; only
        rows of the cut periods are read from it.
        """
        s, table, parts = self.spec, self._table(level), []
        for bound, first in ((start, True), (end, False)):
            if bound is None:
                continue
            (period,) = self._periods([bound])
            instant = self.spark.range(1).select(F.lit(str(bound)).cast("timestamp_ntz").alias("t")).first()["t"]
            whole = instant == period["a"]
            name = F.lit(period["name"])
            table = table.filter((F.col("period") >= name if whole else F.col("period") > name) if first else F.col("period") < name)
            if whole:
                continue
            if df is None:
                raise ValueError(f"{bound} is inside a period: give the data as df")
            parts.append((period, instant, first))
        if len(parts) == 2 and parts[0][0]["name"] == parts[1][0]["name"]:
            parts = [parts[0]]
        for period, instant, first in parts:
            time, dtype = col(s.time), type_of(df, s.time)
            cut = df.filter((time >= typed(dtype, period["a"])) & (time < typed(dtype, period["b"])))
            for bound, later in ((start, True), (end, False)):
                if bound is not None:
                    cut = cut.filter(time >= typed(dtype, bound) if later else time < typed(dtype, bound))
            fresh = self._coarser(self._sums(cut), level)
            table = table.select(*fresh.columns).unionByName(fresh)
        return table if where is None else table.filter(where)

    def map(
        self,
        var: str,
        level: int = 0,
        method: str = "mean",
        by: Sequence[str] = (),
        start: str | None = None,
        end: str | None = None,
        df: DataFrame | None = None,
        where: Column | None = None,
    ) -> DataFrame:
        """A variable per bin of a level: the keys in ``by``, y, x and the mean, sum, count, min or max.

        The rows are those of a binned map of the data at this width (bins whose values are all missing included).
        """
        s = self.spec
        if var not in s.variables:
            raise ValueError(f"{var} is not kept. Kept: {s.variables}")
        require(self._table(level), by)
        value = {"mean": col(f"{var}_sum") / F.when(col(f"{var}_n") > 0, col(f"{var}_n")), "count": col(f"{var}_n")} | {k: col(f"{var}_{k}") for k in ("sum", "min", "max")}
        if method not in value:
            raise ValueError(f"Unknown method: {method}. Known: {list(value)}")
        merged = self._merged(self.sums(level, start, end, df, where), [*by, "_y", "_x"])
        scale = 2**level
        ends = [(F.col(b).cast("double") * F.lit(w * scale)).alias(n) for n, w, b in ((s.y, s.y_width, "_y"), (s.x, s.x_width, "_x"))]
        return merged.select(*[col(k) for k in by], *ends, value[method].alias(var))

    def level_for(self, target: str | int) -> int:
        """The finest level with at most ``target`` bins, else the coarsest one; reads no more than it returns."""
        cells = target_cells(target)
        found = self.spec.levels - 1
        while found > 0 and (cells is None or self._table(found - 1).select("_y", "_x").distinct().count() <= cells):
            found -= 1
        return found
