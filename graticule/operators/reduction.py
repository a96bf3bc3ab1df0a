"""Aggregations over dimensions, groups, regions and bins."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.aggregates import ARRAY_METHODS, GRID_METHODS, array_reducer, check_method, reducer
from graticule.functions.bins import AxisStats, Binning
from graticule.functions.calendar import as_time, calendar_key
from graticule.functions.columns import col, is_numeric, not_null, numeric_columns, require, type_of
from graticule.functions.sizing import GROUP_ROWS
from graticule.model import COORDINATE_NAMES, column_roles
from graticule.operators.percentile import grouped_percentiles

# Named boxes (lat min, lat max, lon min, lon max); they overlap.
REGIONS = {
    "Global": (-90, 90, -180, 180),
    "Tropics (-23.5 to 23.5)": (-23.5, 23.5, -180, 180),
    "Arctic (>66.5N)": (66.5, 90, -180, 180),
    "Antarctic (<66.5S)": (-90, -66.5, -180, 180),
    "Northern Hemisphere": (0, 90, -180, 180),
    "Southern Hemisphere": (-90, 0, -180, 180),
}

# Latitude bands, first match wins.
ZONES = (
    (60.0, "Arctic (60-75N)"),
    (40.0, "Mid-latitude (40-60N)"),
    (20.0, "Subtropical (20-40N)"),
    (None, "Tropical (15-20N)"),
)


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    method: str,
    ddof: int = 1,
    max_group_rows: int | None = GROUP_ROWS,
) -> DataFrame:
    """One named reduction of several columns per group.

    Medians go through the size-checked percentile; all others combine map-side.
    """
    if method == "median":
        out = grouped_percentiles(df, keys, values, [0.5], max_group_rows)
        return out.select(*[col(k) for k in keys], *[col(v)[0].alias(v) for v in values])
    return df.groupBy(*[col(k) for k in keys]).agg(
        *[reducer(method, col(v), ddof).alias(v) for v in values]
    )


def _booleans_as_numbers(df: DataFrame, values: list[str], method: str) -> tuple[DataFrame, list[str]]:
    """Booleans take part in means and sums only."""
    flags = [v for v in values if isinstance(type_of(df, v), T.BooleanType)]
    if method in ("mean", "sum"):
        for v in flags:
            df = df.withColumn(v, col(v).cast("int"))
        return df, values
    return df, [v for v in values if v not in flags]


def reduce_dims(
    df: DataFrame,
    dims: Sequence[str],
    method: str = "mean",
    value_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Reduce over dimensions by grouping over the columns that remain.

    Each column plays one part: dropped (the dimensions), value, or key. Values are
    the ones named; else numbers without a coordinate's name; else all numbers.
    """
    check_method(method)
    if not set(dims) & set(df.columns):
        return df
    parts = _column_parts(df, set(dims), set(value_columns or ()))
    keys = [c for c, part in parts.items() if part == "key"]
    df, values = _booleans_as_numbers(df, [c for c, part in parts.items() if part == "value"], method)
    return grouped(df.filter(not_null(keys)), keys, values, method) if values else df


def _column_parts(df: DataFrame, dropped: set[str], named: set[str]) -> dict[str, str]:
    """The part each column plays in a reduction."""
    kept = {f.name: f for f in df.schema.fields if f.name not in dropped}
    numbers = {c for c in numeric_columns(df, booleans=True) if c in kept}
    plain = {c for c in numbers if c.lower() not in COORDINATE_NAMES}
    values = named if named else plain or numbers
    return {c: "value" if c in values else "key" for c in kept}


def grid_reduce(
    df: DataFrame,
    var: str,
    dim: str | Sequence[str],
    method: str = "mean",
    dims: Sequence[str] | None = None,
) -> DataFrame:
    """Reduce a variable along dimensions the way arrays do (std and var with ddof 0).

    ``first`` and ``last`` go by the reduced dimensions in the order given; see
    :func:`array_reducer` for these, ``prod``, ``any`` and ``all``.
    """
    check_method(method, GRID_METHODS)
    drop = [dim] if isinstance(dim, str) else list(dim)
    require(df, drop + [var])
    dims = list(column_roles(df)) if dims is None else dims
    keep = [d for d in dims if d not in drop and d != var]
    if method not in ARRAY_METHODS:
        return df.groupBy(*[col(k) for k in keep]).agg(array_reducer(method, col(var), [col(d) for d in drop]).alias(var))
    return grouped(df, keep, [var], method, ddof=0)


def profile(df: DataFrame, var: str, dim: str) -> DataFrame:
    """Mean, min and max along one dimension, ordered."""
    v = col(var)
    return (
        df.groupBy(col(dim))
        .agg(F.avg(v).alias(var), F.min(v).alias(f"{var}_min"), F.max(v).alias(f"{var}_max"))
        .orderBy(dim)
    )


def _five_numbers(c: Column) -> Column:
    return F.struct(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    )


def _rows_of(stats: DataFrame, labels: Sequence[str], name: str) -> DataFrame:
    """One row per struct column of a one-row frame."""
    rows = F.array(*[F.struct(F.lit(x).alias(name), col(x).alias("s")) for x in labels])
    return stats.select(F.inline(rows)).select(name, "s.*")


def summary(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Count, mean, std, min and max of every variable in one pass."""
    require(df, variables, "Variables")
    stats = df.agg(*[_five_numbers(col(v)).alias(v) for v in variables])
    return _rows_of(stats, list(variables), "variable")


def region_stats(
    df: DataFrame,
    var: str,
    regions: Mapping[str, tuple[float, float, float, float]] = REGIONS,
    lat: str = "lat",
    lon: str = "lon",
    normalize_lon: bool = False,
) -> DataFrame:
    """Summary of a variable in each box; boxes may overlap, empty ones stay.

    All boxes are conditional aggregates of one scan: no join, no row copies.
    """
    y, x = col(lat), col(lon)
    if normalize_lon:
        x = F.pmod(x + 180.0, F.lit(360.0)) - 180.0
    stats = []
    for name, (lat0, lat1, lon0, lon1) in regions.items():
        inside = y.between(float(lat0), float(lat1)) & x.between(float(lon0), float(lon1))
        stats.append(_five_numbers(F.when(inside, col(var))).alias(name))
    return _rows_of(df.agg(*stats), list(regions), "region")


def coverage(
    df: DataFrame,
    var: str,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Total and valid values and the valid percentage per (binned) cell."""
    bins = Binning(df, lat, lon, target, axes)
    cells = df.select(bins.key(lat), bins.key(lon), col(var)).groupBy(lat, lon)
    return cells.agg(F.count(F.lit(1)).alias("total"), F.count(col(var)).alias("valid")).withColumn(
        "coverage_pct", F.col("valid").cast("double") / F.col("total") * 100.0
    )


def overall_coverage(df: DataFrame, var: str) -> DataFrame:
    """Coverage of the whole variable in one row."""
    total, valid = F.count(F.lit(1)), F.count(col(var))
    return df.agg(
        total.alias("total"),
        valid.alias("valid"),
        F.try_divide(valid.cast("double") * 100.0, total).alias("coverage_pct"),
    )


def zone_stats(
    df: DataFrame,
    var: str,
    bands: Sequence[tuple[float | None, str]] = ZONES,
    lat: str = "lat",
) -> DataFrame:
    """Mean, min, max and count per named latitude band (lower bound, name)."""
    zone: Column | None = None
    for lower, name in bands:
        if lower is None:
            continue
        condition = col(lat) >= float(lower)
        zone = F.when(condition, name) if zone is None else zone.when(condition, name)
    rest = [name for lower, name in bands if lower is None]
    if zone is None:
        zone = F.lit(rest[0] if rest else None)
    elif rest:
        zone = zone.otherwise(rest[0])
    v = col(var)
    return (
        df.select(zone.alias("zone"), v)
        .groupBy("zone")
        .agg(
            F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
            F.count(F.lit(1)).alias("count"),
        )
    )


def band_stats(df: DataFrame, var: str, bands: Sequence[tuple[float, float, str]], lat: str = "lat") -> DataFrame:
    """Mean, min, max and count per band (from, until before, name); the first that holds a row counts.

    Rows in no band are in none; a band that ends at 90 holds the pole. Bands without rows are left out.
    """
    zone: Column | None = None
    for low, high, name in bands:
        inside = (col(lat) >= float(low)) & ((col(lat) < float(high)) | F.lit(high == 90) & (col(lat) <= 90.0))
        zone = F.when(inside, name) if zone is None else zone.when(inside, name)
    if zone is None:
        raise ValueError("No bands given")
    v = col(var)
    rows = df.select(zone.alias("zone"), v).filter("zone IS NOT NULL")
    return rows.groupBy("zone").agg(F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.count(F.lit(1)).alias("count"))


def contrast(df: DataFrame, var: str, by: str, cond_a: Column, cond_b: Column) -> DataFrame:
    """Means under two conditions side by side and b minus a."""
    out = df.groupBy(col(by)).agg(
        F.avg(F.when(cond_a, col(var))).alias("mean_a"), F.avg(F.when(cond_b, col(var))).alias("mean_b")
    )
    return out.withColumn("difference", F.col("mean_b") - F.col("mean_a"))


def histogram(df: DataFrame, var: str, bins: int = 50) -> DataFrame:
    """Counts in equal bins between min and max over all rows; empty bins stay."""
    v = col(var).cast("double")
    ends = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    low = F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")) / F.lit(float(bins))
    edges = ends.select(F.struct(low.alias("low"), width.alias("width"))).scalar()
    counts = (
        df.select(v.alias("_v"))
        .filter(F.col("_v").isNotNull())
        .withColumn("_e", edges)
        .select(F.least(F.floor((F.col("_v") - F.col("_e.low")) / F.col("_e.width")), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (
        every.join(counts, "bin", "left")
        .withColumn("_e", edges)
        .select(
            "bin",
            (F.col("_e.low") + F.col("bin") * F.col("_e.width")).alias("bin_start"),
            (F.col("_e.low") + (F.col("bin") + 1) * F.col("_e.width")).alias("bin_end"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )


KDE_FINE = 16  # bins per bandwidth
KDE_MOMENTS = 7
KDE_REACH = 8  # bandwidths


def kde(df: DataFrame, var: str, points: int = 100) -> DataFrame:
    """Gaussian density estimate (Scott bandwidth) at equally spaced points.

    Values meet in bins of a sixteenth of the bandwidth, whatever their range; only
    bins that hold some exist. A bin keeps the first moments of its values around its
    middle, by which the kernel is expanded, so the sum is that over all values to
    about ten digits. A point meets the bins within eight bandwidths (beyond, a value
    adds less than 1e-14 of its weight) by an equi-join on stretches of that length.
    """
    valid = df.select(col(var).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    stats = valid.agg(
        F.struct(
            F.min("_v").alias("lo"),
            ((F.max("_v") - F.min("_v")) / F.lit(float(points - 1))).alias("gap"),
            (F.stddev_samp("_v") * F.pow(F.count("_v").cast("double"), F.lit(-0.2))).alias("h"),
            F.count("_v").alias("n"),
        )
    ).scalar()
    at = F.try_divide(F.col("_v") - F.col("_s.lo"), F.col("_s.h")) * KDE_FINE
    middle = (F.col("bin") + 0.5) / KDE_FINE
    moments = [F.sum(F.pow(F.col("_u") - middle, F.lit(float(k)))).alias(f"m{k}") for k in range(KDE_MOMENTS)]
    bins = (
        valid.withColumn("_s", stats)
        .select((at / KDE_FINE).alias("_u"), F.floor(at).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(*moments)
        .withColumn("_middle", middle)
        .withColumn("_cell", F.floor(middle / KDE_REACH))
    )
    first, last = F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint")
    ends = valid.limit(1).select(stats.alias("_s"))
    spaced = ends.select("_s", F.explode(F.sequence(first, last)).alias("point")).select(
        "_s", "point", (F.col("_s.lo") + F.col("point") * F.col("_s.gap")).alias("x")
    )
    spaced = spaced.withColumn("_y", F.try_divide(F.col("x") - F.col("_s.lo"), F.col("_s.h")))
    home = F.floor(F.col("_y") / KDE_REACH)
    spaced = spaced.filter(F.col("_y").isNotNull()).withColumn("_cell", F.explode(F.array(home - 1, home, home + 1)))
    # probabilists' Hermite polynomials: the derivatives of the kernel by its centre
    u = F.col("_y") - F.col("_middle")
    hermite = [F.lit(1.0), u]
    for k in range(2, KDE_MOMENTS):
        hermite.append(u * hermite[k - 1] - F.lit(float(k - 1)) * hermite[k - 2])
    series = sum((F.col(f"m{k}") * hermite[k] / F.lit(float(math.factorial(k))) for k in range(1, KDE_MOMENTS)), F.col("m0"))
    weight = F.coalesce(F.sum(F.exp(u * u * F.lit(-0.5)) * series), F.lit(0.0))
    near = spaced.join(bins, "_cell", "left").groupBy("point", "x", "_s").agg(weight.alias("_w"))
    scale = F.col("_s.n") * F.col("_s.h") * F.sqrt(F.lit(2.0) * F.pi())
    return near.select("point", "x", (F.col("_w") / scale).alias("density"))


def calendar_stats(df: DataFrame, var: str, unit: str = "month", time: str = "time") -> DataFrame:
    """Mean, min, max per calendar key (month, season, hour, ...)."""
    v = col(var)
    return (
        df.select(calendar_key(as_time(df, time), unit).alias(unit), v)
        .groupBy(unit)
        .agg(F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    )


def time_series(df: DataFrame, var: str, time: str = "time") -> DataFrame:
    """Mean over everything but time, one row per step."""
    return df.groupBy(col(time)).agg(F.avg(col(var)).alias(var))


def compare_means(a: DataFrame, b: DataFrame, variables: Sequence[str] | None = None) -> DataFrame:
    """Unweighted means of the shared variables of two datasets and compare − primary."""
    shared = list(variables) if variables is not None else [
        c for c in numeric_columns(a)
        if c in b.columns and is_numeric(type_of(b, c)) and c not in column_roles(a)
    ]
    if not shared:
        raise ValueError(f"No shared variables. Primary: {a.columns}, comparison: {b.columns}")
    require(a, shared, "Variables")
    require(b, shared, "Variables")
    # both sides are single rows: the second is read as a subquery
    other = b.agg(F.struct(*[F.avg(col(v)).alias(v) for v in shared])).scalar()
    means = a.agg(*[F.avg(col(v)).alias(v) for v in shared])
    rows = F.array(
        *[
            F.struct(F.lit(v).alias("variable"), col(v).alias("primary_mean"), other[v].alias("compare_mean"))
            for v in shared
        ]
    )
    return means.select(F.inline(rows)).withColumn("difference", F.col("compare_mean") - F.col("primary_mean"))
