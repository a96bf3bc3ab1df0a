"""Quantile sketches kept as a column: built once, merged for any range, with a known rank error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.functions.calendar import as_time, bucket
from graticule.functions.columns import col, require

# Accuracy of a sketch: about 0.24 % of the rows in rank; a sketch takes a few tens of kilobytes at most.
SKETCH_K = 1200
STATE = ("sketch", "n", "min", "max")


def rank_error(k: int = SKETCH_K) -> float:
    """Share of the rows by which a percentile of a sketch can miss its rank, with 99 % confidence.

    The published fit for KLL sketches; merging does not add to it.
    """
    return 2.296 / k**0.9723


def quantile_sketches(
    df: DataFrame,
    var: str,
    by: Sequence[str] = (),
    time: str | None = None,
    freq: str = "D",
    file: str | None = None,
    k: int = SKETCH_K,
) -> DataFrame:
    """One sketch of a variable per group, to be written as a table and merged at will.

    Groups: the columns ``by``, with ``time`` also its bucket of ``freq`` (under the name of
    the time column), with ``file`` also the file a row comes from (under that name; for
    frames read from files), so that a new file adds rows and changes none.

    Columns besides the keys: sketch (null if there are no values), n (values that are not
    null), min and max. NaN counts as +inf.
    Built map-side: the shuffle carries sketches, not rows.
    """
    require(df, [var, *by, *([time] if time else [])])
    keys = [col(b) for b in by]
    if time:
        keys.append(bucket(as_time(df, time), freq).alias(time))
    if file:
        keys.append(df.metadataColumn("_metadata")["file_path"].alias(file))
    x = col(var).cast("double")
    x = F.when(F.isnan(x), F.lit(float("inf"))).otherwise(x)
    return df.groupBy(*keys).agg(
        F.when(F.count(x) > 0, F.kll_sketch_agg_double(x, F.lit(k))).alias("sketch"), F.count(x).alias("n"), F.min(x).alias("min"), F.max(x).alias("max")
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Sketches of coarser groups; filter the fine ones first for a range of times, files or cells."""
    require(sketches, [*STATE, *by])
    return sketches.groupBy(*[col(b) for b in by]).agg(
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
        F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"),
    )


def quantiles(shares: Sequence[float]) -> Column:
    """Values of a sketch row at shares of its values, as an array; null without values."""
    return F.when(F.col("n") > 0, F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in shares]))


def sketch_percentiles(
    sketches: DataFrame,
    var: str,
    ps: Sequence[float] = (0.1, 0.5, 0.9),
    by: Sequence[str] = (),
    k: int = SKETCH_K,
) -> DataFrame:
    """Percentiles from kept sketches, one column each, with n and the rank error of each.

    Values of the data, not interpolations. ``rank_error`` holds with 99 % confidence for a
    percentile. Reads the sketches only.
    """
    from graticule.operators.percentile import percentile_name

    merged = merge_sketches(sketches, by, k).withColumn("_at", quantiles(ps))
    named = [F.col("_at")[i].alias(percentile_name(var, p)) for i, p in enumerate(ps)]
    return merged.select(*[col(b) for b in by], *named, "n", F.lit(rank_error(k)).alias("rank_error"))
