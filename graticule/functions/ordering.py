"""Positions in a total order, found without sorting in a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.functions.columns import col, type_of
from graticule.session import materialize


def sortable(df: DataFrame, name: str) -> bool:
    return not isinstance(type_of(df, name), (T.MapType, T.VariantType))


def global_index(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_row``, the row's position in the total order, without a single-task sort.

    Ties are broken by the remaining columns and, for exact copies, by the row's
    input position, so even one repeated key spreads over several partitions.
    The sorted frame is written out once: range boundaries are sampled, and both
    readers below must see the same ones.
    """
    rest = [c for c in df.columns if c not in order and sortable(df, c)]
    keys = [col(c) for c in order] + [col(c) for c in rest] + [F.col("_in")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.withColumn("_in", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        # the lower 33 bits of the id count the rows of a partition
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_in")
    )
    placed = materialize(placed, "rolling")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per shuffle partition, so both the window and the broadcast are bounded
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("_row", F.col("_start") + F.col("_at"))
        .drop("_part", "_at", "_start")
    )


def carried_max(df: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the largest ``value`` among all rows before each one in the total order, without a single-task sort.

    Rows are sorted in ranges; a range starts from the largest value of those before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [col(c) for c in order]
    placed = materialize(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), "swept")
    tops = placed.groupBy("_part").agg(F.max(col(value)).alias("_top"))
    # one row per range, so both the window and the broadcast are bounded
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_part", F.max("_top").over(earlier).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    swept = placed.join(F.broadcast(tops), "_part").withColumn(out, F.greatest(F.max(col(value)).over(within), F.col("_before")))
    return swept.drop("_part", "_before")
