"""A dataset: named variables over shared dimensions, queryable by SQL or operators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.functions.bins import AxisStats, read_axes
from graticule.functions.columns import (
    at_least,
    at_most,
    col,
    equals,
    is_numeric,
    is_time,
    nan_to_null,
    one_of,
    require,
    type_of,
)
from graticule.functions.ordering import global_index
from graticule.functions.sizing import small_side
from graticule.model import column_roles, detect_roles, numeric_variables
from graticule.operators import profiling, reduction, selection, temporal
from graticule.plans.compose import ResultCache
from graticule.session import configure
from graticule.sources.chunks import axis_of, flatten_chunks


# Positions further from either end of an axis are found by ranges, not by sorting all labels before them.
DEEP = 10_000

# Function names users bring along and their Spark names.
SQL_NAMES = {"approx_percentile_cont": "approx_percentile"}
_QUOTED_OR_NAME = re.compile(r"'(?:[^']|'')*'|\b(" + "|".join(SQL_NAMES) + r")(?=\s*\()", re.IGNORECASE)


def spark_names(query: str) -> str:
    """Function names as Spark knows them; quoted text stays as it is."""
    return _QUOTED_OR_NAME.sub(lambda m: SQL_NAMES[m[1].lower()] if m[1] else m[0], query)


class Grid:
    """One wide DataFrame holding the dimensions and every variable.

    A variable's table is a projection (free in a columnar file). ``axes`` holds
    the ordered labels of dimensions, either as a long axes table (dim, idx,
    coord_num, coord_ts, coord_str) or as (idx, label) rows per dimension; without
    it, positions follow the sorted distinct labels of the column.
    """

    def __init__(
        self,
        df: DataFrame,
        dims: Sequence[str] | None = None,
        variables: Sequence[str] | None = None,
        attrs: Mapping[str, Any] | None = None,
        axes: Mapping[str, DataFrame] | DataFrame | None = None,
    ) -> None:
        configure(df.sparkSession)
        found = list(column_roles(df)) if dims is None else list(dims)
        require(df, found, "Dimensions")
        available = [c for c in df.columns if c not in found]
        if variables is None:
            names = [v for v in (numeric_variables(df) if dims is None else available) if v in available]
        else:
            missing = [v for v in variables if v not in available]
            if missing:
                raise ValueError(f"Variables {missing} not found in dataset. Available: {available}")
            names = list(variables)
        self.dims, self.variables = found, names
        self.df = nan_to_null(df.select(*[col(c) for c in found + names]), names)
        self.attrs = dict(attrs or {})
        if isinstance(axes, DataFrame):
            axes = {d: axis_of(axes, d, _label_column(df, d)) for d in found}
        self.axes = dict(axes or {})
        self._derived: dict[str, DataFrame] = {}
        self._stats: dict[str, AxisStats] = {}
        self._cache = ResultCache()

    @classmethod
    def from_chunks(
        cls,
        chunks: DataFrame,
        axes: Mapping[str, DataFrame],
        dims: Sequence[str],
        var: str = "value",
        attrs: Mapping[str, Any] | None = None,
    ) -> "Grid":
        """A one-variable dataset from array chunks and their axes."""
        return cls(flatten_chunks(chunks, axes, dims, var), dims, [var], attrs, axes)

    @property
    def spark(self):
        return self.df.sparkSession

    # ---- tables and SQL ----

    def variable(self, name: str) -> DataFrame:
        """Dimensions and one variable."""
        return selection.select_variables(self.df, [name], self.dims)

    def register(self) -> "Grid":
        """One temp view per variable and derived table of this dataset."""
        for v in self.variables:
            self.variable(v).createOrReplaceTempView(v)
        for name, derived in self._derived.items():
            derived.createOrReplaceTempView(name)
        return self

    def tables(self) -> list[str]:
        return sorted({*self.variables, *self._derived})

    def normalize(self, name: str) -> str:
        """Strip quotes; match exactly, then ignoring case; else unchanged."""
        bare = name.strip('"').strip("'").strip("`")
        known = self.tables()
        if bare in known:
            return bare
        return next((t for t in known if t.lower() == bare.lower()), bare)

    def table(self, name: str) -> DataFrame:
        found = self.normalize(name)
        if found in self.variables:
            return self.variable(found)
        if found in self._derived:
            return self._derived[found]
        raise ValueError(f"Table {name!r} not found. Available: {self.tables()}")

    def sql(self, query: str, args: Mapping[str, Any] | Sequence[Any] | None = None) -> DataFrame:
        """Run SQL over the views; parameters (? or :name) are typed, not pasted."""
        self.register()
        query = spark_names(query)
        return self.spark.sql(query, args=args) if args else self.spark.sql(query)

    def define(self, name: str, query: str, args: Mapping[str, Any] | Sequence[Any] | None = None) -> DataFrame:
        """Add a derived table sharing the views; it belongs to this dataset alone."""
        self._derived[name] = self.sql(query, args)
        return self._derived[name]

    def get(self, table: str, drop_missing: bool = False, **query: Any) -> DataFrame:
        """A table filtered by keywords; optionally without missing cells."""
        name = self.normalize(table)
        df = selection.get(self.table(name), **query)
        return selection.drop_missing(df, name) if drop_missing and name in self.variables else df

    def cached(self, df: DataFrame) -> DataFrame:
        return self._cache.get(df)

    def clear_cache(self) -> None:
        self._cache.clear()

    # ---- selection by label and position ----

    def axis(self, dim: str) -> DataFrame:
        """Ordered labels of a dimension as (idx, label), or its distinct labels."""
        if dim not in self.dims:
            raise ValueError(f"Dimension {dim!r} not found. Available: {self.dims}")
        if dim in self.axes:
            return self.axes[dim].select("idx", "label")
        return self.df.select(col(dim).alias("label")).filter(F.col("label").isNotNull()).distinct()

    def label_at(self, dim: str, position: int) -> Any:
        """Label at a position; negative counts from the end. One row is fetched."""
        axis = self.axis(dim)
        if dim in self.axes:
            if position < 0:
                position += axis.agg(F.max("idx")).first()[0] + 1
            row = axis.filter(F.col("idx") == position).first()
        elif (position if position >= 0 else -position - 1) > DEEP:
            row = placed_labels(axis).filter(F.col("idx") == (position if position >= 0 else axis.count() + position)).first()
        else:
            order = F.col("label").asc() if position >= 0 else F.col("label").desc()
            row = axis.orderBy(order).offset(position if position >= 0 else -position - 1).limit(1).first()
        if row is None:
            raise IndexError(f"Position {position} is outside dimension {dim!r}")
        return row["label"]

    def axis_stats(self, dims: Sequence[str] | None = None) -> dict[str, AxisStats]:
        """Length and ends of numeric axes, read once; pass them to the map operators."""
        roles = detect_roles(self.df)
        names = dims or [roles[r] for r in ("latitude", "longitude") if roles[r]]
        unread = [n for n in names if n not in self._stats]
        if unread:
            self._stats |= read_axes(self.df, unread)
        return {n: self._stats[n] for n in names if n in self._stats}

    # ---- reductions ----

    def reduce(self, var: str, dim: str | Sequence[str], method: str = "mean") -> DataFrame:
        return reduction.grid_reduce(self.variable(var), var, dim, method, self.dims)

    def resample(self, var: str, freq: str = "MS", method: str = "mean", time: str = "time") -> DataFrame:
        return temporal.grid_resample(self.variable(var), var, freq, method, time, self.dims)

    # ---- descriptions (small results, fetched) ----

    def dimension_info(self) -> dict[str, dict[str, Any]]:
        """Profile of every dimension; categorical ones list their values."""
        info = {}
        for row in profiling.dimension_profile(self.df, self.dims).collect():
            d = row["dim"]
            entry = {"size": row["size"], "dtype": row["dtype"], "type": row["kind"], "role": row["role"]}
            if row["kind"] == "datetime":
                entry |= {"min": str(row["min_time"]), "max": str(row["max_time"])}
            elif row["kind"] == "numeric":
                entry |= {"min": row["min"], "max": row["max"], "step": self._step(d, row["step"])}
            else:
                entry |= self._enum(d)
            info[d] = entry
        return info

    def _step(self, dim: str, ascending: float | None) -> float | None:
        if dim not in self.axes:
            return ascending
        first = self.axes[dim].filter(F.col("idx") < 2).orderBy("idx").collect()
        return float(first[1]["label"] - first[0]["label"]) if len(first) > 1 else None

    def _enum(self, name: str) -> dict[str, Any]:
        """All sorted distinct values as a frame: nothing is fetched, nothing cut."""
        return {"values": profiling.schema_enums(self.df, [name]).select("value")}

    def schema(self, table: str | None = None, limit: int | None = None, shuffle: bool = False) -> dict[str, Any]:
        """Type, range or values per column and the row count under ``__len__``; without a table, that of each.

        With a limit, ranges come from that many rows; the count is always the whole.
        """
        if table is None:
            return {t: self.schema(t, limit, shuffle) for t in self.tables()}
        df = self.table(table)
        total = df.count() if limit is not None else None
        out: dict[str, Any] = {}
        for row in profiling.schema_profile(df, limit, shuffle).collect():
            entry: dict[str, Any] = {"type": row["type"]}
            dtype = type_of(df, row["column"])
            if is_numeric(dtype):
                cast = int if entry["type"] == "integer" else float
                for bound, value in (("inclusiveMinimum", row["min"]), ("inclusiveMaximum", row["max"])):
                    entry[bound] = None if value is None else cast(value)
            elif is_time(dtype):
                entry |= {"inclusiveMinimum": str(row["min_time"]), "inclusiveMaximum": str(row["max_time"])}
            elif entry["type"] in ("string", "boolean"):
                entry["enum"] = profiling.schema_enums(df, [row["column"]]).select("value")
            out[row["column"]] = entry
            out["__len__"] = row["rows"] if total is None else total
        return out

    def metadata(self, var: str | None = None) -> dict[str, Any]:
        """Description, columns, dimensions, shape and attributes of a variable's table; without one, of each."""
        if var is None:
            return {v: self.metadata(v) for v in sorted(self.variables)}
        table = {r["column"]: r.asDict() for r in profiling.table_metadata(self.variable(var), self.dims).collect()}
        sizes = [table[d].get("size") for d in self.dims]
        about, units = table[var]["description"] or var, table[var]["units"]
        extent = " x ".join(map("{}({})".format, self.dims, sizes))
        return {
            "description": f"{about}{f' [{units}]' if units else ''} — dimensions: {extent}",
            "columns": {name: self._column_entry(row) for name, row in table.items()},
            "dimensions": list(self.dims),
            "shape": sizes,
            "dataset_attrs": dict(self.attrs),
        }

    def _column_entry(self, row: dict[str, Any]) -> dict[str, Any]:
        """A row of the metadata table under the interface's names, without what is unknown."""
        # fixed names of the interface
        entry = {"data_type": row["data_type"], "is_coordinate": row["is_coordinate"], "is_dimension": row["is_coordinate"] or None}
        entry |= {k: row.get(k) for k in ("units", "description", "min", "max", "size")}
        return {k: v for k, v in entry.items() if v is not None}

    def estimate_size(self, var: str | None = None) -> dict[str, Any]:
        """Rows, columns and bytes of a variable's table; without one, of each."""
        if var is None:
            return {v: self.estimate_size(v) for v in sorted(self.variables)}
        return profiling.estimate_size(self.variable(var)).first().asDict()


def _label_column(df: DataFrame, dim: str) -> str:
    dtype = type_of(df, dim)
    return "coord_ts" if is_time(dtype) else "coord_num" if is_numeric(dtype) else "coord_str"


def placed_labels(labels: DataFrame) -> DataFrame:
    """Distinct labels with their positions, (idx, label), sorted in ranges and never in one task."""
    return global_index(labels.select("label"), ["label"]).select(F.col("_row").alias("idx"), "label")


def sel(grid: Grid, method: str | None = None, **labels: Any) -> DataFrame:
    """Select by label: a scalar drops its dimension, a list or slice keeps it.

    A label that does not exist is an error unless method="nearest".
    """
    df = grid.df
    for dim, label in labels.items():
        if isinstance(label, slice):
            if label.start is not None:
                df = df.filter(at_least(df, dim, label.start))
            if label.stop is not None:
                df = df.filter(at_most(df, dim, label.stop))
            continue
        scalar = not isinstance(label, (list, tuple))
        wanted = [label] if scalar else list(label)
        if method == "nearest":
            wanted = [_nearest_label(grid, dim, w) for w in wanted]
        else:
            _check_labels(grid, dim, wanted)
        df = df.filter(equals(df, dim, wanted[0]) if scalar else one_of(df, dim, wanted))
        df = df.drop(dim) if scalar else df
    return df


def isel(grid: Grid, **positions: Any) -> DataFrame:
    """Select by position along dimensions: an int drops its dimension, a list or slice keeps it."""
    df = grid.df
    for dim, position in positions.items():
        if isinstance(position, slice):
            df = _position_range(grid, df, dim, position)
        elif isinstance(position, (list, tuple)):
            df = df.filter(one_of(df, dim, [grid.label_at(dim, p) for p in position]))
        else:
            df = df.filter(equals(df, dim, grid.label_at(dim, position))).drop(dim)
    return df


def _check_labels(grid: Grid, dim: str, wanted: list[Any]) -> None:
    axis = grid.axis(dim)
    found = axis.filter(one_of(axis, "label", wanted)).select("label").distinct().count()
    if found < len(set(wanted)):
        raise KeyError(f"Not all of {wanted} found in dimension {dim!r}")


def _nearest_label(grid: Grid, dim: str, value: Any) -> Any:
    label = F.col("label")
    if is_time(type_of(grid.df, dim)):
        def micros(c):
            return F.unix_micros(c.cast("timestamp"))

        distance = F.abs(micros(label) - micros(F.lit(str(value))))
    else:
        distance = F.abs(label - F.lit(float(value)))
    return grid.axis(dim).agg(F.min(F.struct(distance.alias("d"), label.alias("label")))["label"]).first()[0]


def _position_range(grid: Grid, df: DataFrame, dim: str, where: slice) -> DataFrame:
    """Rows whose label lies at one of the positions of a slice."""
    axis = grid.axis(dim)
    size = axis.count()
    start, stop, step = where.indices(size)
    if step < 0:
        raise ValueError("slices run forwards")
    if start >= stop:
        return df.filter(F.lit(False))
    if dim not in grid.axes and step == 1:
        # positions follow the sorted labels: a run of positions is a range of labels
        low, high = grid.label_at(dim, start), grid.label_at(dim, stop - 1)
        return df.filter(at_least(df, dim, low) & at_most(df, dim, high))
    if dim not in grid.axes:
        axis = placed_labels(axis)
    idx = F.col("idx")
    chosen = axis.filter(idx.between(start, stop - 1) & ((idx - start) % step == 0)).select(
        F.col("label").alias(dim)
    )
    return df.join(small_side(chosen), dim, "left_semi")
