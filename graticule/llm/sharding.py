"""Shards along a Hilbert curve through several metadata dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graticule.llm.common import table
from graticule.session import materialize


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """The curve as a machine: per state and cell corner, the digit along the curve and the next state.

    A state is an entry corner and a main direction. The digits follow the Gray code,
    turned and mirrored by the state, so that cells one after another always touch.
    """
    corners = 1 << dims

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & (corners - 1)

    def entry(w: int) -> int:
        even = 2 * ((w - 1) // 2) if w else 0
        return even ^ (even >> 1)

    def direction(w: int) -> int:
        ones = (w if w % 2 else w - 1) if w else 0  # its trailing ones name the direction
        return ((ones ^ (ones + 1)).bit_length() - 1) % dims if w else 0

    digits, states = [], []
    for state in range(corners * dims):
        e, d = state // dims, state % dims
        for corner in range(corners):
            t = turn(corner ^ e, -(d + 1))
            w = t
            for shift in range(1, dims):
                w ^= t >> shift
            digits.append(w)
            states.append((e ^ turn(entry(w), d + 1)) * dims + (d + direction(w) + 1) % dims)
    return digits, states


def hilbert_index(levels: Sequence[Column], bits: int) -> Column:
    """Index along the curve of a cell given by one number below 2**bits per dimension."""
    dims = len(levels)
    if dims * bits > 62:
        raise ValueError("the index must fit a long")
    if dims == 1:
        return levels[0].cast("long")
    digits, states = (F.array(*[F.lit(x) for x in t]) for t in curve_tables(dims))

    def step(acc: Column, bit: Column) -> Column:
        corner = F.lit(0)
        for k, level in enumerate(levels):
            corner = corner + F.call_function("shiftright", level.cast("int"), bit).bitwiseAND(F.lit(1)) * F.lit(1 << k)
        at = acc["state"] * F.lit(1 << dims) + corner + F.lit(1)
        return F.struct(
            (acc["index"] * F.lit(1 << dims).cast("long") + F.element_at(digits, at)).alias("index"),
            F.element_at(states, at).alias("state"),
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    order = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(order, start, step)["index"]


def _in_order(df: DataFrame, name: str) -> Column:
    """A column to compare by: numbers and times as a double, all else as a string in byte order."""
    column, kind = df[name], df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("string")


def _string_borders(df: DataFrame, value: Column, levels: int) -> list[str]:
    """The values at which 1, 2, ... of ``levels`` equal shares of the rows are reached, in byte order.

    Distinct values are counted (map-side first), dealt by range and summed up within each
    range. The driver sees one number per shuffle partition and fewer than ``levels`` values.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = df.select(value.alias("v")).dropna().groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    dealt = materialize(counted.repartitionByRange(parts, "v").withColumn("_part", F.spark_partition_id()), "values")
    starts, total = {}, 0
    for part, n in sorted((r["_part"], r["n"]) for r in dealt.groupBy("_part").agg(F.sum("n").alias("n")).collect()):
        starts[part] = total
        total += n
    if not total:
        return []
    before = F.element_at(F.create_map(*[F.lit(x) for p, s in starts.items() for x in (p, F.lit(s).cast("long"))]), F.col("_part"))
    upto = before + F.sum("n").over(Window.partitionBy("_part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = dealt.withColumn("_upto", upto)
    reached = F.expr(f"least(_upto * {levels} div {total}, {levels - 1}) > (_upto - n) * {levels} div {total}")
    return [r["v"] for r in summed.where(reached).select("v").collect()]


def quantised(df: DataFrame, dims: Sequence[str], bits: int = 5, accuracy: int = 2000) -> list[Column]:
    """Per dimension the number of its quantile, 0 to 2**bits - 1; null is 0.

    The 2**bits - 1 borders are read from all rows: those of numbers and times in one pass of
    mergeable sketches, those of strings from the counts of whole values.
    """
    values = {d: _in_order(df, d) for d in dims}
    strings = [d for d in dims if isinstance(df.select(values[d]).schema[0].dataType, T.StringType)]
    cuts = [k / (1 << bits) for k in range(1, 1 << bits)]
    sketched = [d for d in dims if d not in strings]
    borders = dict(zip(sketched, df.agg(*[F.percentile_approx(values[d], cuts, accuracy) for d in sketched]).first())) if sketched else {}
    borders |= {d: _string_borders(df, values[d], 1 << bits) for d in strings}
    levels = []
    for d in dims:
        marks = sorted(set(borders[d] or []), key=lambda m: m.encode() if isinstance(m, str) else m)
        if not marks:
            levels.append(F.lit(0))
            continue
        # a value's level is the number of borders below it, found by halving
        def below(lo: int, hi: int, c: Column, marks: list = marks) -> Column:
            if lo == hi:
                return F.lit(lo)
            mid = (lo + hi) // 2
            return F.when(c <= F.lit(marks[mid]), below(lo, mid, c)).otherwise(below(mid + 1, hi, c))

        levels.append(F.when(values[d].isNull(), 0).otherwise(below(0, len(marks), values[d])))
    return levels


def ranked(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows with ``_rank``, their place in the order of the keys (all columns), and their number.

    Rows are dealt by range and sorted once; a partition's first place is the sum of the
    counts of those before it, one number per shuffle partition. The keys must tell rows
    apart so that a repeated value spreads over partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "shards",
    )
    counts = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = {}, 0
    for part, n in counts:
        starts[part] = total
        total += n
    if not total:
        return placed.withColumn("_rank", F.col("_at")).drop("_part", "_at"), 0
    first = F.element_at(F.create_map(*[F.lit(x) for p, s in starts.items() for x in (p, F.lit(s).cast("long"))]), F.col("_part"))
    return placed.withColumn("_rank", first + F.col("_at")).drop("_part", "_at"), total


def hilbert_shards(
    docs: DataFrame,
    dims: Sequence[str],
    shards: int = 16,
    doc_id: str = "doc_id",
    text: str = "text",
    bits: int = 5,
) -> DataFrame:
    """Cut the rows into runs along a Hilbert curve through the quantised dimensions.

    Returns one row per input row: doc_id, size (UTF-8 bytes of the text plus 1),
    text_crc32, curve (index of the cell), the dimensions as ``dim_0``, ``dim_1``, ...,
    shard and slot. Rows are ordered by curve, checksum, size and id; run ``s`` of
    ``shards`` takes the places from ceil(s n / shards) on, so counts differ by at most
    one and equal texts stand together. Neighbours on the curve are neighbours in every
    dimension, so a shard covers a small range of each and readers can skip it.

    A null text has size 1 and the checksum of nothing; null dimensions count as smallest;
    repeated rows each get a slot; an empty table gives no rows; other columns are not
    read. Only ids, sizes and dimensions are shuffled, never texts. JVM-side throughout.
    """
    levels = quantised(docs, dims, bits)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("_bytes"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        hilbert_index(levels, bits).alias("curve"),
        *[docs[d].alias(f"dim_{i}") for i, d in enumerate(dims)],
        F.monotonically_increasing_id().alias("_tag"),
    ).select("doc_id", (F.col("_bytes") + 1).alias("size"), "text_crc32", "curve", *[f"dim_{i}" for i in range(len(dims))], "_tag")
    placed, total = ranked(rows, ["curve", "text_crc32", "size", "doc_id", "_tag"])
    n = max(total, 1)
    return (
        placed.withColumn("shard", F.expr(f"cast(_rank * {shards} div {n} as int)"))
        .withColumn("slot", F.col("_rank") - F.expr(f"(cast(shard as long) * {n} + {shards - 1}) div {shards}"))
        .drop("_rank", "_tag")
    )


def query(spark, sf_dir):
    """All documents along a curve through source, language and length: 16 shards of equal counts."""
    docs = table(spark, sf_dir, "documents")
    return hilbert_shards(docs, ["source", "lang", "n_chars"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
