"""Compositions: chained transforms, previews, the climate series, reuse."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.functions.columns import col
from graticule.operators.reduction import time_series
from graticule.operators.temporal import anomaly, resample, trend

CACHE_ENTRIES = 20
PREVIEW_ROWS = 1_000


def chain(df: DataFrame, ops: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply transforms one after another; the result is a single lazy plan."""
    return reduce(lambda current, op: current.transform(op), ops, df)


def climate_series(
    df: DataFrame, var: str, freq: str = "MS", groupby: str = "month", time: str = "time"
) -> DataFrame:
    """Mean series, resampled, with its trend and its anomaly."""
    return chain(
        df,
        [
            lambda d: time_series(d, var, time),
            lambda d: resample(d, time, freq, "mean"),
            lambda d: trend(d, var, time=time),
            lambda d: anomaly(d, var, groupby, time),
        ],
    )


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: Sequence[str] = ()) -> DataFrame:
    """The first n rows, each with the total row count of the whole result."""
    total = df.agg(F.count(F.lit(1))).scalar()
    ordered = df.orderBy(*[col(c) for c in order_by]) if order_by else df
    return ordered.limit(n).withColumn("total_rows", total)


class ResultCache:
    """Keeps results that are asked for again; the oldest leave first.

    Entries are persisted frames: a lost executor only means recomputing its part.
    """

    def __init__(self, entries: int = CACHE_ENTRIES) -> None:
        self.entries = entries
        self._kept: OrderedDict[int, DataFrame] = OrderedDict()

    def get(self, df: DataFrame) -> DataFrame:
        key = df.semanticHash()
        kept = self._kept.get(key)
        if kept is not None and kept.sameSemantics(df):
            return kept
        if len(self._kept) >= self.entries:
            _, oldest = self._kept.popitem(last=False)
            oldest.unpersist()
        self._kept[key] = df.persist(StorageLevel.MEMORY_AND_DISK)
        return self._kept[key]

    def clear(self) -> None:
        for df in self._kept.values():
            df.unpersist()
        self._kept.clear()

    def __len__(self) -> int:
        return len(self._kept)
