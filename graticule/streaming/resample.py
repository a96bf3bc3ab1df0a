"""Resampling a stream: the same buckets, closed by a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.functions.aggregates import check_method, reducer
from graticule.functions.columns import col

# Bucket widths a window can have (calendar buckets vary in length).
WINDOWS = {"h": "1 hour", "D": "1 day"}


def stream_resample(
    df: DataFrame,
    time: str,
    freq: str,
    method: str,
    values: Sequence[str],
    watermark: str = "1 hour",
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """Resample without gap filling; works on batch and streaming frames alike.

    Watermarks need a zoned timestamp, so the time column is cast first.
    """
    check_method(method)
    if freq not in WINDOWS:
        raise ValueError(f"Unknown frequency: {freq}. Known: {list(WINDOWS)}")
    timed = df.withColumn(time, col(time).cast("timestamp")).withWatermark(time, watermark)
    window = F.window(col(time), WINDOWS[freq])
    out = timed.groupBy(*[col(g) for g in group_cols], window.alias("_w")).agg(
        *[reducer(method, col(v)).alias(v) for v in values]
    )
    return out.select(
        *[col(g) for g in group_cols], F.col("_w.start").cast("timestamp_ntz").alias(time), *[col(v) for v in values]
    )
