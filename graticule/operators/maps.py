"""Map-shaped queries: binned means over two axes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.functions.bins import AxisStats, Binning
from graticule.functions.columns import col


def map_mean(
    df: DataFrame,
    var: str,
    target: str | int | None = "auto",
    x: str = "lon",
    y: str = "lat",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Mean of a variable per (binned) cell of two axes, all others averaged.

    Rows shrink to cells map-side, so the shuffle carries cells, not rows.
    """
    bins = Binning(df, y, x, target, axes)
    return df.select(bins.key(y), bins.key(x), col(var)).groupBy(y, x).agg(F.avg(col(var)).alias(var))


def hovmoller(
    df: DataFrame,
    var: str,
    axis: str = "lat",
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    time: str = "time",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Mean over time and one (binned) horizontal axis."""
    bins = Binning(df, lat, lon, target, axes)
    return (
        df.select(col(time), bins.key(axis), col(var))
        .groupBy(time, axis)
        .agg(F.avg(col(var)).alias(var))
        .orderBy(time, axis)
    )


def cross_section(
    df: DataFrame,
    var: str,
    mode: str = "lat_level",
    target: str | int | None = "auto",
    lat: str = "lat",
    lon: str = "lon",
    level: str = "level",
    time: str = "time",
    axes: dict[str, AxisStats] | None = None,
) -> DataFrame:
    """Mean over latitude (binned) and level, or time and level."""
    if mode == "lat_level":
        across, key = lat, Binning(df, lat, lon, target, axes).key(lat)
    elif mode == "time_level":
        across, key = time, col(time)
    else:
        raise ValueError(f"Unknown mode: {mode}. Known: ['lat_level', 'time_level']")
    return (
        df.select(key, col(level), col(var))
        .groupBy(across, level)
        .agg(F.avg(col(var)).alias(var))
        .orderBy(across, level)
    )


def to_matrix(
    df: DataFrame,
    row: str,
    column: str,
    value: str,
    values: Sequence | None = None,
) -> DataFrame:
    """Long table to matrix, duplicates averaged.

    With the column labels given each becomes a column, however many they are.
    Without, each row holds one array sorted by label; its length is that of the
    column axis, duplicates being averaged before.
    """
    if values is not None:
        return df.groupBy(col(row)).pivot(column, list(values)).agg(F.avg(col(value)))
    cells = df.groupBy(col(row), col(column)).agg(F.avg(col(value)).alias("value"))
    return cells.groupBy(col(row)).agg(
        F.sort_array(F.collect_list(F.struct(col(column).alias("label"), "value"))).alias("cells")
    )
