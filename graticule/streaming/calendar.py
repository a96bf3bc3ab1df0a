"""Resampling a stream into weeks, months, quarters and years as well, closed by a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.aggregates import check_method, reducer
from graticule.functions.calendar import as_time, bucket, bucket_end, check_frequency, label, needs_origin
from graticule.functions.columns import col, require, type_of, typed


def resample_stream(
    df: DataFrame,
    time: str,
    freq: str,
    method: str,
    values: Sequence[str],
    watermark: str = "1 hour",
    group_cols: Sequence[str] = (),
    origin: str | None = None,
) -> DataFrame:
    """Resample without gap filling at any frequency; the same rows from batch and streaming frames.

    A bucket is written once, when the latest time of the batches before is ``watermark`` past its
    end; a row that comes late still counts as long as its bucket is open, whatever its
    delay. What comes after is dropped (Spark counts it as dropped by the watermark).

    A bucket is a struct of start and end that carries the watermark of the time it is made
    from, as that of ``F.window`` does; so Spark itself keeps the state per group and open
    bucket, drops what is late and gives closed buckets out, and partial sums are formed
    before the shuffle: a group with a third of all rows is one row per task.

    The last buckets of a stream that ends stay open: see :func:`close_stream`. Buckets that
    do not divide a day (2D, 7h) need the day they count from as ``origin``. Rows without
    a time or group are left out.
    """
    check_method(method)
    check_frequency(freq)
    require(df, [time, *values, *group_cols])
    if needs_origin(freq) and origin is None:
        raise ValueError(f"{freq} counts from a first day, which a stream does not know: give origin")
    first = F.lit(origin).cast("timestamp_ntz") if origin is not None else None
    seen = df.withColumn("_seen", as_time(df, time).cast("timestamp")).withWatermark("_seen", watermark)
    start = bucket(F.col("_seen").cast("timestamp_ntz"), freq, first)
    keys = [col(c) for c in group_cols]
    span = F.struct(start.cast("timestamp").alias("start"), bucket_end(start, freq).cast("timestamp").alias("end"))
    span = span.alias("_bucket", metadata=seen.schema["_seen"].metadata)
    # one condition that names the time, so that it stays behind the watermark: rows without a group move it, too
    missing = F.array(*[c.isNull() for c in (F.col("_seen"), *keys)])
    rows = seen.filter(~F.array_contains(missing, True)).select(*keys, span, *[col(v) for v in values])
    out = rows.groupBy(*keys, "_bucket").agg(*[reducer(method, col(v)).alias(v) for v in values])
    return out.select(*keys, label(F.col("_bucket.start").cast("timestamp_ntz"), freq).alias(time), *[col(v) for v in values])


def close_stream(spark: SparkSession, path: str, schema: T.StructType, time: str, at: str) -> None:
    """Add a file that closes all buckets which end the watermark's delay before ``at``.

    For a stream over the files of a folder that gets no more rows: the file holds one row,
    all NULL but for its time. It moves the watermark; without a group it is in no
    result, and without groups its own bucket stays open.
    """
    row = spark.range(1).select(*[(typed(f.dataType, at) if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
    if not isinstance(type_of(row, time), (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise ValueError(f"{time} is not a time")
    row.coalesce(1).write.mode("append").parquet(path)
