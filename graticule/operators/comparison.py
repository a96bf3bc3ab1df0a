"""Differences, overlays and correlations of periods, levels, variables and datasets."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.functions.aggregates import guarded_corr
from graticule.functions.bins import AxisStats, Binning
from graticule.functions.calendar import as_time
from graticule.functions.columns import at_least, at_most, col, equals, not_null
from graticule.model import column_roles
from graticule.operators.selection import nearest_cell

MIN_REFERENCE_STEPS = 5


def _difference(
    df: DataFrame, var: str, first: Column, second: Column, bins: Binning, lat: str, lon: str
) -> DataFrame:
    """Mean maps under two conditions from one scan; cells with rows in both remain."""
    flagged = df.select(
        bins.key(lat), bins.key(lon), col(var).alias("_v"), first.alias("_1"), second.alias("_2")
    ).filter(F.col("_1") | F.col("_2"))
    cells = flagged.groupBy(lat, lon).agg(
        F.avg(F.when(F.col("_1"), F.col("_v"))).alias(f"{var}_1"),
        F.avg(F.when(F.col("_2"), F.col("_v"))).alias(f"{var}_2"),
        F.count_if("_1").alias("_n1"),
        F.count_if("_2").alias("_n2"),
    )
    return (
        cells.filter((F.col("_n1") > 0) & (F.col("_n2") > 0))
        .drop("_n1", "_n2")
        .withColumn("difference", col(f"{var}_2") - col(f"{var}_1"))
    )


def half_periods(df: DataFrame, time: str = "time") -> tuple[tuple[str, str], tuple[str, str]]:
    """Both halves of the time range as whole days; they share their middle day."""
    t = as_time(df, time)
    first, last = df.agg(F.min(t), F.max(t)).first()
    if first is None:
        return ("1970-01-01", "1970-01-01"), ("1970-01-01", "1970-01-01")
    days = [str(x.date()) for x in (first, first + (last - first) / 2, last)]
    return (days[0], days[1]), (days[1], days[2])


def diff_periods(
    df: DataFrame,
    var: str,
    p1: tuple[Any, Any] | None = None,
    p2: tuple[Any, Any] | None = None,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    time: str = "time",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Mean map of the second period minus the first; both ends of a period belong to it.

    Without periods the two halves of the time range are compared.
    """
    if p1 is None or p2 is None:
        p1, p2 = half_periods(df, time)

    def inside(period: tuple[Any, Any]) -> Column:
        return at_least(df, time, period[0]) & at_most(df, time, period[1])

    return _difference(df, var, inside(p1), inside(p2), Binning(df, lat, lon, target, axes), lat, lon)


def diff_levels(
    df: DataFrame,
    var: str,
    l1: float | None = None,
    l2: float | None = None,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    level: str = "level",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Mean map of the second level minus the first (default: highest minus lowest)."""
    if l1 is None or l2 is None:
        l1, l2 = df.agg(F.min(col(level)), F.max(col(level))).first()
    bins = Binning(df, lat, lon, target, axes)
    return _difference(df, var, equals(df, level, l1), equals(df, level, l2), bins, lat, lon)


def difference_limit(diff: DataFrame) -> DataFrame:
    """Largest absolute difference of a difference map, one row."""
    return diff.agg(F.max(F.abs("difference")).alias("max_abs_difference"))


def _pair_sums(var: str, centre: Column, side: str) -> list[Column]:
    v = col(var).cast("double") - centre
    return [
        F.count(F.lit(1)).alias(f"rows_{side}"),
        F.count(v).alias(f"n_{side}"),
        F.coalesce(F.sum(v), F.lit(0.0)).alias(f"s_{side}"),
        F.coalesce(F.sum(v * v), F.lit(0.0)).alias(f"q_{side}"),
    ]


def cross_variable(
    a: DataFrame,
    b: DataFrame | None = None,
    var_a: str | None = None,
    var_b: str | None = None,
    dims: Sequence[str] | None = None,
) -> DataFrame:
    """Pearson r and point count of two variables joined on all shared coordinates.

    Every pair of rows with equal coordinates counts, but none is built: each
    side shrinks to a few sums per coordinate tuple before the join, so repeated
    coordinates (or one that holds much of the data) cost nothing extra; more
    points than a 64-bit number holds give NULL points and still a correlation. Two
    variables of one frame (``b`` left out) need one scan and no join.
    """
    if b is None and (var_a is None or var_b is None):
        raise ValueError("name both variables of a single frame")
    other = a if b is None else b
    var_a, var_b = var_a or a.columns[-1], var_b or other.columns[-1]
    if dims is None and b is None:
        dims = [c for c in a.columns if c in column_roles(a)]
    shared = [c for c in dims or a.columns if c in other.columns and c not in (var_a, var_b)]
    if not shared:
        raise ValueError("No shared coordinates between variables")
    keys = [col(k) for k in shared]
    # sums are taken around the means, which keeps them well conditioned
    sums_a = _pair_sums(var_a, F.col("_mean_a"), "a")
    sums_b = _pair_sums(var_b, F.col("_mean_b"), "b")
    mean_a, mean_b = F.avg(col(var_a).cast("double")), F.avg(col(var_b).cast("double"))
    if b is None:
        means = a.agg(F.struct(mean_a.alias("a"), mean_b.alias("b"))).scalar()
        centred = a.filter(not_null(shared)).withColumn("_m", means)
        centred = centred.withColumns({"_mean_a": F.col("_m.a"), "_mean_b": F.col("_m.b")})
        pairs = centred.groupBy(*keys).agg(*sums_a, *sums_b)
    else:
        left = a.withColumn("_mean_a", a.agg(mean_a).scalar()).groupBy(*keys).agg(*sums_a)
        right = b.withColumn("_mean_b", b.agg(mean_b).scalar()).groupBy(*keys).agg(*sums_b)
        pairs = left.join(right, shared)
    totals = pairs.agg(
        F.expr("coalesce(sum(cast(rows_a AS decimal(19, 0)) * cast(rows_b AS decimal(19, 0))), 0)").alias("points"),
        F.sum(F.col("n_a").cast("double") * F.col("n_b")).alias("n"),
        F.sum(F.col("s_a") * F.col("n_b")).alias("sa"),
        F.sum(F.col("s_b") * F.col("n_a")).alias("sb"),
        F.sum(F.col("q_a") * F.col("n_b")).alias("qa"),
        F.sum(F.col("q_b") * F.col("n_a")).alias("qb"),
        F.sum(F.col("s_a") * F.col("s_b")).alias("ab"),
    )
    n = F.col("n")
    spread_a = F.greatest(F.col("qa") * n - F.col("sa") * F.col("sa"), F.lit(0.0))
    spread_b = F.greatest(F.col("qb") * n - F.col("sb") * F.col("sb"), F.lit(0.0))
    together = F.col("ab") * n - F.col("sa") * F.col("sb")
    return totals.select(
        F.lit(",".join(shared)).alias("shared_coords"),
        F.expr("try_cast(points AS bigint)").alias("points"),
        F.try_divide(together, F.sqrt(spread_a) * F.sqrt(spread_b)).alias("correlation"),
    )


def overlay(
    a: DataFrame,
    var_a: str,
    var_b: str,
    b: DataFrame | None = None,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Mean maps of two variables aligned on cells.

    Two variables of one frame need one scan and no join; a second frame is
    binned like the first and joined on the cells.
    """
    bins = Binning(a, lat, lon, target, axes)
    if b is None:
        both = a.select(bins.key(lat), bins.key(lon), *[col(v) for v in dict.fromkeys((var_a, var_b))])
        return both.groupBy(lat, lon).agg(F.avg(col(var_a)).alias("fill"), F.avg(col(var_b)).alias("contour"))

    def mean_map(df: DataFrame, var: str, name: str) -> DataFrame:
        cells = df.select(bins.key(lat), bins.key(lon), col(var)).groupBy(lat, lon)
        return cells.agg(F.avg(col(var)).alias(name))

    return mean_map(a, var_a, "fill").join(mean_map(b, var_b, "contour"), [lat, lon], "full")


def compare_grids(
    a: DataFrame,
    b: DataFrame,
    var: str,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    b_lat: str | None = None,
    b_lon: str | None = None,
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Difference map of two datasets, compare − primary, on the primary's bins."""
    bins = Binning(a, lat, lon, target, axes)

    def mean_map(df: DataFrame, y: str, x: str, name: str) -> DataFrame:
        cells = df.select(bins.key(lat, y), bins.key(lon, x), col(var)).groupBy(lat, lon)
        return cells.agg(F.avg(col(var)).alias(name))

    primary = mean_map(a, lat, lon, f"{var}_primary")
    compared = mean_map(b, b_lat or lat, b_lon or lon, f"{var}_compare")
    return primary.join(compared, [lat, lon]).withColumn(
        "difference", col(f"{var}_compare") - col(f"{var}_primary")
    )


def correlation_map(
    df: DataFrame,
    var: str,
    lat0: float,
    lon0: float,
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    time: str = "time",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Correlation of each (binned) cell's series with that of the cell nearest a point.

    The reference cell is looked up first (one row), so its series is read with a
    plain filter that the file reader can use. Both sides are aggregated before
    the join on time: one row per step against one row per step and cell. No
    broadcast is forced; adaptive execution sees the real size of the reference
    series and picks it when small. Fewer than 5 reference rows give no result.
    """
    bins = Binning(df, lat, lon, target, axes)
    cells = (
        df.select(col(time), bins.key(lat), bins.key(lon), col(var))
        .groupBy(time, lat, lon)
        .agg(F.avg(col(var)).alias(var))
        .filter(col(var).isNotNull())
    )
    cell = nearest_cell(df, lat0, lon0, lat, lon).first()
    here = df.filter(equals(df, lat, cell[lat]) & equals(df, lon, cell[lon]) if cell else F.lit(False))
    if here.limit(MIN_REFERENCE_STEPS).count() < MIN_REFERENCE_STEPS:
        cells = cells.filter(F.lit(False))
    reference = here.groupBy(col(time)).agg(F.avg(col(var)).alias("_ref"))
    return (
        cells.join(reference, time, "left")
        .groupBy(lat, lon)
        .agg(guarded_corr(col(var), F.col("_ref")).alias("correlation"))
    )
