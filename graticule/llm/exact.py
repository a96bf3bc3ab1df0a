"""Exact duplicates found by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.llm.common import WHITE, settled, table, tagged, without
from graticule.session import materialize

PREFIX = 64  # characters hashed in the second step
BUCKETS = 1 << 20  # buckets of surviving groups sent to all executors: at most 8 MB of numbers


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _several(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that more than one row has; counted before the shuffle, so a hot key is one row per task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("_length", "_prefix"), F.lit(BUCKETS))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", all_hashes: bool = False) -> DataFrame:
    """Every row with the row that stays for it: columns _tag, doc_id, keep_id, group_size, kept, sha256.

    1. Rows are grouped by the length of the normalised text; lengths of one row are done.
    2. Among the rest, rows are grouped by length and the hash of a prefix; single rows are done.
    3. Only texts whose group survives both are hashed whole (SHA-256) and grouped by that.

    The surviving groups reach the scan as a bounded table of buckets, so no text is
    shuffled; a bucket shared by chance costs a hash, never a wrong group. ``sha256`` is
    null for rows settled earlier unless ``all_hashes`` asks for the digest of every text.

    Of equal texts the row with the smallest doc_id stays (null ids last, repeated rows by
    tag), so exactly one row of a group is kept. A null text equals the empty one;
    an empty table gives no rows; other columns are not read.
    """
    docs = settled(docs)
    narrow = tagged(
        docs, F.col(doc_id).alias("doc_id"), F.length(normalised(F.col(text))).alias("_length"),
        F.xxhash64(F.substring(normalised(F.col(text)), 1, PREFIX)).alias("_prefix"),
    )
    narrow = materialize(narrow, "lengths")
    alike = narrow.join(_several(narrow, "_length"), "_length", "left_semi")
    buckets = _several(alike, "_length", "_prefix").select(_bucket().alias("_bucket")).distinct()

    whole = tagged(docs, F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("_text"))
    marked = whole.select(
        "_tag", "doc_id", "_text", F.length("_text").alias("_length"), F.xxhash64(F.substring("_text", 1, PREFIX)).alias("_prefix")
    ).withColumn("_bucket", _bucket())
    marked = marked.join(F.broadcast(buckets.withColumn("_alive", F.lit(True))), "_bucket", "left")
    digest = F.sha2(F.col("_text").cast("binary"), 256)
    hashed = materialize(
        marked.select(
            "_tag", "doc_id", F.coalesce("_alive", F.lit(False)).alias("_alive"),
            (digest if all_hashes else F.when(F.col("_alive"), digest)).alias("sha256"),
        ),
        "hashes",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_tag"))
    groups = (
        hashed.where("_alive").groupBy("sha256").agg(F.count(F.lit(1)).alias("group_size"), first.alias("_first"))
        .where("group_size > 1")
        .select(F.col("sha256").alias("_of"), "group_size", F.col("_first.doc_id").alias("_keep"), F.col("_first._tag").alias("_keep_tag"))
    )
    return hashed.join(groups, F.col("_alive") & (F.col("sha256") == F.col("_of")), "left").select(
        "_tag", "doc_id",
        F.when(F.col("_of").isNull(), F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_keep_tag") == F.col("_tag"), F.lit(True)).alias("kept"),
        "sha256",
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    docs = settled(docs)
    return without(docs, exact_groups(docs, doc_id, text).where("NOT kept"))


def query(spark, sf_dir):
    """All documents: the row that stays for each, and the digest of its normalised text."""
    groups = exact_groups(table(spark, sf_dir, "documents"), all_hashes=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


SQL = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""
