"""Size checks that decide between a small-side plan and a scalable one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.functions.columns import col
from graticule.session import cut_lineage

# A side is sent to every executor only when it is known to hold at most this many rows.
BROADCAST_ROWS = 200_000
# A group is handled by one task only when it is known to hold at most this many rows.
GROUP_ROWS = 2_000_000


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether a given (not expensive to compute) frame has at most max_rows rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a row count; without it the join shuffles as usual."""
    return F.broadcast(df) if fits(df, max_rows) else df


def settled_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """An aggregate about to be joined back to many rows, computed once and measured.

    Small results are broadcast, so the many rows do not move at all. Larger ones
    come from the checkpoint through a plain shuffle, which is the shape adaptive
    execution needs to split a hot key.
    """
    settled = cut_lineage(df)
    return F.broadcast(settled) if settled.count() <= max_rows else settled


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows in the biggest group; counted map-side first, one number returned."""
    if not keys:
        return df.count()
    sizes = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0
