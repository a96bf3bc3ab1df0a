"""Power spectra of evenly sampled series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.calendar import days
from graticule.functions.columns import col, not_null
from graticule.functions.ordering import global_index
from graticule.functions.sizing import GROUP_ROWS, settled_side

MIN_STEPS = 8


def spectrum(
    df: DataFrame,
    var: str,
    by: Sequence[str] | None = None,
    time: str = "time",
    max_steps: int = GROUP_ROWS,
) -> DataFrame:
    """Power per frequency of the mean series, overall or per group; DC is left out.

    Rows are averaged to one per (group, step) first, so a series is no longer
    than the time axis, however many raw rows share it. The axis is measured: up
    to ``max_steps`` each series is transformed by one task, beyond that every
    transform is itself spread over the cluster. Series with fewer than 8 steps
    give no rows.
    """
    groups = list(by or [])
    t = days(df, time)
    steps = (
        df.select(*[col(g) for g in groups], t.alias("_t"), col(var).cast("double").alias("_v"))
        .filter(not_null(["_t", *groups]))
        .groupBy(*[col(g) for g in groups], "_t")
        .agg(F.avg("_v").alias("_v"))
    )
    if df.select(t.alias("_t")).distinct().count() > max_steps:
        return _spread_spectrum(steps, groups)
    schema = T.StructType(
        [df.schema[g] for g in groups]
        + [
            T.StructField("k", T.LongType()),
            T.StructField("frequency", T.DoubleType()),
            T.StructField("period_days", T.DoubleType()),
            T.StructField("power", T.DoubleType()),
        ]
    )

    def transform(series: pd.DataFrame) -> pd.DataFrame:
        series = series.sort_values("_t")
        values = series["_v"].dropna().to_numpy()
        if len(series) < MIN_STEPS or len(values) < 2:
            return pd.DataFrame({f.name: [] for f in schema.fields})
        t = series["_t"].to_numpy()
        power = np.abs(np.fft.rfft(values - values.mean())) ** 2
        frequency = np.fft.rfftfreq(len(values))
        result = pd.DataFrame(
            {
                "k": np.arange(1, len(frequency)),
                "frequency": frequency[1:],
                "period_days": (t[1] - t[0]) / frequency[1:],
                "power": power[1:],
            }
        )
        for g in reversed(groups):
            result.insert(0, g, series[g].iloc[0])
        return result[result["period_days"] > 0]

    return steps.groupBy(*[col(g) for g in groups]).applyInPandas(transform, schema)


def peak_period(spec: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """Period with the most power, per series; ties go to the lower frequency."""
    best = F.max_by("period_days", F.struct(F.col("power"), -F.col("k")))
    return spec.groupBy(*[col(g) for g in by or []]).agg(
        best.alias("peak_period_days"), F.max("power").alias("peak_power")
    )


def _spread_spectrum(steps: DataFrame, groups: list[str]) -> DataFrame:
    """The same power for series of any length, no task holding a whole series.

    A transform of length n is written as a convolution (chirp transform), whose
    own transforms have a power of two as length. Such a length splits evenly into
    n1 x n2, so each task handles only short strided parts (see ``_fft``).
    """
    keys = groups or ["_all"]
    steps = steps if groups else steps.withColumn("_all", F.lit(0))
    first = F.min("_t").alias("_t0")
    starts = settled_side(steps.groupBy(*[col(k) for k in keys]).agg(first))
    about = settled_side(
        steps.join(starts, keys)
        .groupBy(*[col(k) for k in keys], "_t0")
        .agg(
            F.min(F.when(F.col("_t") > F.col("_t0"), F.col("_t"))).alias("_t1"),
            F.count(F.lit(1)).alias("_steps"),
            F.count("_v").alias("n"),
            F.avg("_v").alias("_mean"),
        )
        .filter((F.col("_steps") >= MIN_STEPS) & (F.col("n") >= 2))
        .withColumn("_bits", F.ceil(F.log2(F.col("n") * 2 - 1)).cast("int"))
        .withColumn("n1", F.expr("shiftleft(1L, _bits div 2)"))
        .withColumn("n2", F.expr("shiftleft(1L, _bits - _bits div 2)"))
        # ids survive in the checkpoint this side is read from
        .withColumn("series", F.monotonically_increasing_id())
    )
    values = steps.filter(F.col("_v").isNotNull()).join(about, keys)
    placed = global_index(
        values.select("series", "_t", "n", "n1", "n2", (F.col("_v") - F.col("_mean")).alias("_x")), ["series", "_t"]
    )
    heads = settled_side(placed.groupBy("series").agg(F.min("_row").alias("_head")))
    j = (F.col("_row") - F.col("_head")).alias("j")
    x = placed.join(heads, "series").select("series", "n", "n1", "n2", j, "_x")
    # j * j modulo 2 n keeps the angle small, so it stays exact
    angle = F.lit(np.pi) * ((F.col("j") * F.col("j")) % (F.col("n") * 2)) / F.col("n")
    chirp = x.withColumn("_c", F.cos(angle)).withColumn("_s", F.sin(angle))
    zero, size = F.lit(0.0), F.col("n1") * F.col("n2")

    def entry(pos: Column, *parts: Column) -> Column:
        names = ("re0", "im0", "re1", "im1")
        return F.struct(pos.alias("pos"), *[p.alias(name) for p, name in zip(parts, names)])

    both = F.array(
        entry(F.col("j"), F.col("_x") * F.col("_c"), -F.col("_x") * F.col("_s"), F.col("_c"), F.col("_s")),
        entry(F.when(F.col("j") > 0, size - F.col("j")), zero, zero, F.col("_c"), F.col("_s")),
    )
    laid = chirp.select("series", "n", "n1", "n2", F.inline(both)).filter(F.col("pos").isNotNull())
    moved = _fft(laid, 2, inverse=False)
    a, b, c, d = (F.col(name) for name in ("re0", "im0", "re1", "im1"))
    product = moved.select("series", "n", "n1", "n2", "pos", (a * c - b * d).alias("re0"), (a * d + b * c).alias("im0"))
    back = _fft(product, 1, inverse=True).filter((F.col("pos") >= 1) & (F.col("pos") <= F.floor(F.col("n") / 2)))
    frequency = F.col("pos") / F.col("n").cast("double")
    return back.join(about.select("series", "_t0", "_t1", *[col(g) for g in groups]), "series").select(
        *[col(g) for g in groups],
        F.col("pos").alias("k"),
        frequency.alias("frequency"),
        ((F.col("_t1") - F.col("_t0")) / frequency).alias("period_days"),
        (F.col("re0") * F.col("re0") + F.col("im0") * F.col("im0")).alias("power"),
    )


def _fft(df: DataFrame, columns: int, inverse: bool) -> DataFrame:
    """Transform of length n1 * n2 of one or two complex columns, missing positions being 0.

    Short transforms over every n2-th position, a rotation, then short transforms
    across: two shuffles, and a group is n1 or n2 values, about the square root.
    """
    parts = [f"{p}{i}" for i in range(columns) for p in ("re", "im")]
    schema = "series long, n long, n1 long, n2 long, pos long, " + ", ".join(f"{p} double" for p in parts)
    short = np.fft.ifft if inverse else np.fft.fft
    sign = 1.0 if inverse else -1.0

    def rows(part: pd.DataFrame, pos: np.ndarray, values: list[np.ndarray]) -> pd.DataFrame:
        out = {name: np.full(len(pos), part[name].iloc[0]) for name in ("series", "n", "n1", "n2")}
        out["pos"] = pos
        for i, v in enumerate(values):
            out[f"re{i}"], out[f"im{i}"] = v.real, v.imag
        return pd.DataFrame(out)

    def dense(part: pd.DataFrame, at: np.ndarray, size: int) -> list[np.ndarray]:
        values = []
        for i in range(columns):
            v = np.zeros(size, dtype=complex)
            v[at] = part[f"re{i}"].to_numpy() + 1j * part[f"im{i}"].to_numpy()
            values.append(short(v))
        return values

    def strided(part: pd.DataFrame) -> pd.DataFrame:
        n1, n2 = int(part["n1"].iloc[0]), int(part["n2"].iloc[0])
        pos = part["pos"].to_numpy()
        offset, k = int(pos[0] % n2), np.arange(n1)
        turn = np.exp(sign * 2j * np.pi * (offset * k) / (n1 * n2))
        # laid out as offset * n1 + k: the next step gathers equal k
        return rows(part, offset * n1 + k, [v * turn for v in dense(part, pos // n2, n1)])

    def across(part: pd.DataFrame) -> pd.DataFrame:
        n1, n2 = int(part["n1"].iloc[0]), int(part["n2"].iloc[0])
        pos = part["pos"].to_numpy()
        return rows(part, int(pos[0] % n1) + n1 * np.arange(n2), dense(part, pos // n1, n2))

    df = df.select("series", "n", "n1", "n2", "pos", *parts)
    df = df.groupBy("series", (F.col("pos") % F.col("n2")).alias("_o")).applyInPandas(strided, schema)
    return df.groupBy("series", (F.col("pos") % F.col("n1")).alias("_k")).applyInPandas(across, schema)
