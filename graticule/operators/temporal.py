"""Resampling, climatologies, anomalies and trends."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.aggregates import ARRAY_METHODS, GRID_METHODS, array_reducer, check_method
from graticule.functions.calendar import (
    CALENDAR_KEYS,
    MONTH_NAMES,
    as_time,
    bucket,
    calendar_key,
    check_frequency,
    days,
    label,
    needs_origin,
    step,
)
from graticule.functions.columns import col, not_null, numeric_columns, require
from graticule.functions.sizing import settled_side
from graticule.model import column_roles
from graticule.operators.reduction import _booleans_as_numbers, grouped

_EMPTY_BUCKET_ZERO = ("sum", "count")
# Empty buckets made from one row at a time.
GAP_STEPS = 1000


def resample(
    df: DataFrame,
    time: str = "time",
    freq: str = "MS",
    method: str = "mean",
    group_cols: Sequence[str] | None = None,
    values: Sequence[str] | None = None,
    fill_gaps: bool = True,
) -> DataFrame:
    """Resample every numeric column; empty buckets between first and last appear.

    With ``group_cols`` each group spans its own first to last bucket. Buckets that do not
    divide a day (2D, 7h) count from midnight of the first day of all rows.
    """
    if time not in df.columns:
        return df
    check_method(method)
    check_frequency(freq)
    groups = [g for g in (group_cols or []) if g in df.columns]
    if values is None:
        skip = {time, *(group_cols or [])}
        values = [c for c in numeric_columns(df, booleans=True) if c not in skip]
    df, values = _booleans_as_numbers(df, list(values), method)
    t = as_time(df, time)
    rows = df.filter(not_null([time, *groups]))
    origin = rows.agg(F.min(t)).scalar() if needs_origin(freq) else None
    start = bucket(t, freq, origin)
    bucketed = rows.select(*[col(g) for g in groups], start.alias(time), *[col(v) for v in values])
    out = grouped(bucketed, [*groups, time], values, method)
    if fill_gaps:
        empty = F.lit(0) if method in _EMPTY_BUCKET_ZERO else F.lit(None)
        out = _fill_between(out, time, freq, groups, values, empty)
    return _labelled(out, time, freq)


def _labelled(out: DataFrame, time: str, freq: str) -> DataFrame:
    return out.select(*[label(col(c), freq).alias(c) if c == time else col(c) for c in out.columns])


def _fill_between(
    out: DataFrame,
    time: str,
    freq: str,
    groups: list[str],
    values: list[str],
    empty: Column,
    span: Column | None = None,
) -> DataFrame:
    """Add the empty buckets that follow each bucket of a group.

    Works on aggregated rows (one per group and bucket), so a window never holds
    more than the buckets of one group, however many raw rows the group has: a
    century of hours is under 900,000 rows. The data are read once. With a
    ``span`` all groups share its first and last bucket.
    """
    order = Window.partitionBy(*[col(g) for g in groups]).orderBy(time)
    following = F.lead(time).over(order)
    start, last = col(time), col(time)
    if span is not None:
        out = out.withColumn("_span", span)
        start = F.when(F.lag(time).over(order).isNull(), F.col("_span.a")).otherwise(col(time))
        last = F.col("_span.b")
    ahead = out.withColumn("_to", F.coalesce(following - step(freq), last)).withColumn("_from", start)
    # a long gap is cut first, so that no row holds it as one array
    runs = ahead.withColumn("_from", F.explode(F.sequence("_from", "_to", step(freq, GAP_STEPS))))
    upto = F.least("_to", F.col("_from") + step(freq, GAP_STEPS - 1))
    spread = runs.withColumn("_bucket", F.explode(F.sequence("_from", upto, step(freq))))
    kept = [F.when(F.col("_bucket") == col(time), col(v)).otherwise(empty).alias(v) for v in values]
    return spread.select(*[col(g) for g in groups], F.col("_bucket").alias(time), *kept)


def grid_resample(
    df: DataFrame,
    var: str,
    freq: str = "MS",
    method: str = "mean",
    time: str = "time",
    dims: Sequence[str] | None = None,
) -> DataFrame:
    """Resample per cell on one shared time axis; empty buckets are NULL; std, var ddof 0.

    ``first`` and ``last`` go by time; see :func:`array_reducer` for these, ``prod``, ``any`` and ``all``.
    """
    check_method(method, GRID_METHODS)
    check_frequency(freq)
    require(df, [time, var])
    dims = list(column_roles(df)) if dims is None else list(dims)
    cell = [d for d in dims if d not in (time, var)]
    t = as_time(df, time)
    rows = df.filter(not_null([time, *cell]))
    # buckets that do not divide a day count from the first day of the whole dataset
    origin = df.agg(F.min(t)).scalar() if needs_origin(freq) else None
    bucketed = rows.select(*[col(c) for c in cell], bucket(t, freq, origin).alias(time), col(var), t.alias("_at"))
    if method in ARRAY_METHODS:
        out = grouped(bucketed.drop("_at"), [*cell, time], [var], method, ddof=0)
    else:
        out = bucketed.groupBy(*[col(c) for c in cell], time).agg(array_reducer(method, col(var), [F.col("_at")]).alias(var))
    # the time axis is that of the whole dataset; this reads one column
    ends = df.agg(F.min(t).alias("a"), F.max(t).alias("b"))
    day = F.col("a") if needs_origin(freq) else None
    span = ends.select(F.struct(bucket(F.col("a"), freq, day).alias("a"), bucket(F.col("b"), freq, day).alias("b"))).scalar()
    if not cell:
        ends = out.agg(F.min(time).alias("a"), F.max(time).alias("b"))
        runs = ends.select(F.explode(F.sequence("a", "b", step(freq, GAP_STEPS))).alias("a"), "b")
        spine = runs.select(F.explode(F.sequence("a", F.least("b", F.col("a") + step(freq, GAP_STEPS - 1)), step(freq))).alias(time))
        return _labelled(spine.join(out, time, "left").select(time, var), time, freq)
    return _labelled(_fill_between(out, time, freq, cell, [var], F.lit(None), span), time, freq)


def _baseline(df: DataFrame, var: str, groupby: str | None, time: str, out: str, combine) -> DataFrame:
    """Attach combine(value, mean of the row's calendar group) as a new column."""
    if var not in df.columns:
        return df
    if groupby is not None and groupby not in CALENDAR_KEYS:
        raise ValueError(f"Unknown grouping: {groupby}. Known: {list(CALENDAR_KEYS)}")
    if groupby is None or time not in df.columns:
        mean = df.agg(F.avg(col(var))).scalar()
        return df.withColumn(out, combine(col(var), mean))
    key = calendar_key(as_time(df, time), groupby)
    means = df.select(key.alias("_k"), col(var)).groupBy("_k").agg(F.avg(col(var)).alias("_mean"))
    # a calendar grouping has at most 366 keys, so this side is bounded by construction
    joined = df.withColumn("_k", key).join(F.broadcast(means), "_k", "left")
    return joined.select(*[col(c) for c in df.columns], combine(col(var), F.col("_mean")).alias(out))


def anomaly(df: DataFrame, var: str, groupby: str | None = "month", time: str = "time") -> DataFrame:
    """Value minus the mean of its calendar group, as ``{var}_anomaly``."""
    return _baseline(df, var, groupby, time, f"{var}_anomaly", lambda v, mean: v - mean)


def climatology(df: DataFrame, var: str, groupby: str | None = "month", time: str = "time") -> DataFrame:
    """Mean of the row's calendar group beside it, as ``{var}_climatology``."""
    return _baseline(df, var, groupby, time, f"{var}_climatology", lambda v, mean: mean)


def climatology_table(df: DataFrame, var: str, groupby: str = "month", time: str = "time") -> DataFrame:
    """One row per calendar group; months also get their name."""
    if groupby not in CALENDAR_KEYS:
        raise ValueError(f"Unknown grouping: {groupby}. Known: {list(CALENDAR_KEYS)}")
    key = calendar_key(as_time(df, time), groupby).alias(groupby)
    table = (
        df.filter(col(time).isNotNull())
        .select(key, col(var))
        .groupBy(groupby)
        .agg(F.avg(col(var)).alias(f"{var}_climatology"))
    )
    if groupby == "month":
        names = F.array(*[F.lit(n) for n in MONTH_NAMES])
        table = table.withColumn("month_name", names[F.col("month").cast("int") - 1])
    return table.orderBy(groupby)


def trend(
    df: DataFrame,
    var: str,
    degree: int = 1,
    by: Sequence[str] | None = None,
    time: str = "time",
) -> DataFrame:
    """Polynomial fit over time: ``{var}_trend`` and the residual ``{var}_detrended``.

    The fit is a handful of sums per group, so rows combine map-side. Without
    groups the result is read back as a subquery; with groups the fits are computed
    once and joined back, broadcast when few.
    """
    if degree < 1:
        raise ValueError("degree must be at least 1")
    columns = df.columns
    t, v = days(df, time), col(var).cast("double")
    points = df.select(*[col(k) for k in by or []], t.alias("_t"), v.alias("_v")).filter(not_null(["_t", "_v"]))
    if degree == 1:
        fit = F.struct(
            F.avg("_v").alias("v0"),
            F.avg("_t").alias("t0"),
            F.coalesce(F.regr_slope("_v", "_t"), F.lit(0.0)).alias("slope"),
        )
        fitted = F.col("_fit.v0") + F.col("_fit.slope") * (t - F.col("_fit.t0"))
    else:
        return _polynomial(df, var, degree, list(by or []), points, t, v)

    if by:
        require(df, by)
        fits = settled_side(points.groupBy(*[col(k) for k in by]).agg(fit.alias("_fit")))
        joined = df.join(fits, list(by), "left")
    else:
        joined = df.withColumn("_fit", points.agg(fit).scalar())
    return joined.select(
        *[col(c) for c in columns], fitted.alias(f"{var}_trend"), (v - fitted).alias(f"{var}_detrended")
    )


def _polynomial(df: DataFrame, var: str, degree: int, by: list[str], points: DataFrame, t: Column, v: Column) -> DataFrame:
    """A trend of degree 2 or more.

    Each group's time is scaled to -1 .. 1 by its own ends and its values are taken from
    its own mean, then the sums are those of Chebyshev polynomials: the system stays well
    conditioned for high degrees, short groups late on the axis and large values alike.
    """
    require(df, by)
    low, high = F.min("_t"), F.max("_t")
    frame = F.struct(((low + high) / 2.0).alias("middle"), F.greatest((high - low) / 2.0, F.lit(1e-9)).alias("half"), F.avg("_v").alias("mean")).alias("_frame")
    keys = [col(k) for k in by]
    if by:
        frames = settled_side(points.groupBy(*keys).agg(frame))
        framed = points.join(frames, by)
    else:
        framed = points.withColumn("_frame", points.agg(frame).scalar())

    def chebyshev(u: Column) -> list[Column]:
        out = [F.lit(1.0), u]
        while len(out) <= degree:
            out.append(2.0 * u * out[-1] - out[-2])
        return out

    def scaled(time: Column) -> Column:
        return (time - F.col("_frame.middle")) / F.col("_frame.half")

    basis = F.array(*chebyshev(F.col("_u")))
    framed = framed.select(*keys, scaled(F.col("_t")).alias("_u"), (F.col("_v") - F.col("_frame.mean")).alias("_d")).withColumn("_p", basis)
    at = range(degree + 1)
    products = F.array(*[F.sum(F.col("_p")[i] * F.col("_p")[j]) for i in at for j in at])
    fit = _solve_basis(products, F.array(*[F.sum(F.col("_p")[i] * F.col("_d")) for i in at])).alias("_fit")
    if by:
        fits = settled_side(framed.groupBy(*keys).agg(fit).join(frames, by))
        joined = df.join(fits, by, "left")
    else:
        joined = df.withColumn("_frame", points.agg(frame).scalar()).withColumn("_fit", framed.agg(fit).scalar())
    # Clenshaw's recurrence
    u, ahead, after = scaled(t), F.lit(0.0), F.lit(0.0)
    for i in range(degree, 0, -1):
        ahead, after = F.col("_fit")[i] + 2.0 * u * ahead - after, ahead
    fitted = F.col("_frame.mean") + F.col("_fit")[0] + u * ahead - after
    return joined.select(*[col(c) for c in df.columns], fitted.alias(f"{var}_trend"), (v - fitted).alias(f"{var}_detrended"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve_basis(products: pd.Series, moments: pd.Series) -> pd.Series:
    """Coefficients of the least-squares systems of a batch; of deficient ones, the shortest."""
    found = np.array([p is not None and m is not None and all(x is not None for x in (*p, *m)) for p, m in zip(products, moments)], dtype=bool)
    solved = [None] * len(products)
    if found.any():
        p, m = (np.stack([np.asarray(x, dtype=float) for x in s[found]]) for s in (products, moments))
        inverse = np.linalg.pinv(p.reshape(len(p), m.shape[1], m.shape[1]), hermitian=True)
        for at, coefficients in zip(np.flatnonzero(found), np.einsum("gij,gj->gi", inverse, m)):
            solved[at] = coefficients
    return pd.Series(solved)
