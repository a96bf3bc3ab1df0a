"""Adaptive spatial binning: how many cells a map query may return."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.functions.columns import col

# Cells aimed at per resolution; None means one key per grid cell.
TARGET_CELLS = {"low": 10_000, "medium": 40_000, "high": 100_000, "auto": 60_000, "full": None}
MIN_BINS = 10


@dataclass(frozen=True)
class AxisStats:
    """Length and ends of one coordinate axis, when already known."""

    size: int
    min: float
    max: float


def target_cells(target: str | int | None) -> int | None:
    return TARGET_CELLS[target] if isinstance(target, str) else target


def read_axes(df: DataFrame, names: Sequence[str]) -> dict[str, AxisStats]:
    """Length and ends of axes from their columns: one job, one fetched row per axis.

    Each axis is its own one-column scan whose values are deduplicated map-side,
    so no row is copied per axis and the shuffle carries axis values only.
    """

    def one(name: str) -> DataFrame:
        x = col(name).cast("double").alias("x")
        values = df.select(x).filter(x.isNotNull()).distinct()
        return values.agg(F.lit(name), F.count("x"), F.min("x"), F.max("x"))

    rows = reduce(DataFrame.union, [one(n) for n in names]).collect()
    return {name: AxisStats(size, low, high) for name, size, low, high in rows if size}


def bin_width(axis: AxisStats, cells: int, target: int | None) -> float | None:
    """Width of the bins of an axis; None where no binning applies."""
    span = axis.max - axis.min
    if target is None or cells <= target or span <= 0:
        return None
    ratio = math.sqrt(cells / target)
    return span / max(MIN_BINS, int(axis.size / ratio))


def bin_expr(c: Column, width: float | None) -> Column:
    """Key of the bin a coordinate falls into, or the coordinate if nothing is binned.

    Bins are anchored at 0, so one more key than bins can appear.
    """
    return c if width is None else F.floor(c / F.lit(width)).cast("double") * F.lit(width)


class Binning:
    """Bin keys for a latitude/longitude pair, decided from the whole dataset.

    The number of bins depends on the axes, so these must be known before the
    query is built, as they are when a dataset is opened. Pass ``axes`` (from
    ``Grid.axis_stats``) to read them once per dataset instead of once per map.
    """

    def __init__(
        self,
        df: DataFrame,
        lat: str = "lat",
        lon: str = "lon",
        target: str | int | None = "auto",
        axes: dict[str, AxisStats] | None = None,
    ) -> None:
        target = target_cells(target)
        self._width: dict[str, float | None] = {}
        if target is None:
            return
        if not axes or lat not in axes or lon not in axes:
            axes = read_axes(df, [lat, lon])
        if lat in axes and lon in axes:
            cells = axes[lat].size * axes[lon].size
            self._width = {name: bin_width(axes[name], cells, target) for name in (lat, lon)}

    def key(self, name: str, source: str | None = None) -> Column:
        """Bin key of axis ``name``, read from column ``source`` (default: same name)."""
        return bin_expr(col(source or name), self._width.get(name)).alias(name)
