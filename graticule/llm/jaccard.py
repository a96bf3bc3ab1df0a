"""Exact similarity join of word n-gram sets with a token-group matrix."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graticule.llm.common import settled, table, tagged, without
from graticule.llm.components import components
from graticule.session import materialize

CHUNK = 2000  # rows whose tokens are compared within a task before the shuffle
MEMBERS = 64  # documents of a group at most
BUCKETS = 1 << 20  # of the table that spares most texts a shuffle: at most 8 MB
CODE = (1 << 40) - 1
# Odd multipliers of the n-gram hash, one per place: powers of one odd constant.
_STEP = 0x9E3779B97F4A7C15


def ngrams(raw: bytes, words: int) -> np.ndarray:
    """Distinct hashes (sorted, unsigned) of the word n-grams; fewer words make one; none, none."""
    from xxhash import xxh3_64_intdigest

    given = raw.lower().split()
    if not given:
        return np.zeros(0, dtype=np.uint64)
    codes = np.fromiter(map(xxh3_64_intdigest, given), dtype=np.uint64, count=len(given))
    n = max(1, len(codes) - words + 1)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(min(words, len(codes))):
        h += codes[i : i + n] * np.uint64(pow(_STEP, i + 1, 1 << 64))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return np.unique(h)


def overlap_needed(n: int, percent: int) -> int:
    """Tokens a set of n must share with any partner: percent of n, as the union has n at least."""
    return -(-percent * n // 100)


def reserve(n: int) -> int:
    """Tokens added to the shortest sufficient prefix, so that as many of it must be shared."""
    return max(1, -(-n // 10))


def prefix_length(n: int, percent: int) -> int:
    """Of the tokens in the order of their hashes, partners share ``reserve`` of these at least."""
    return min(n, n - overlap_needed(n, percent) + reserve(n))


def split_shared(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, pa.ListArray, pa.ListArray]:
    """For the sets of a chunk: how many tokens each shares within it, the tokens only it has,
    and one witness for each token that several have."""
    lengths = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), lengths)
    order = np.argsort(tokens, kind="stable")
    ranked = tokens[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, dtype=bool)
    run = np.cumsum(new) - 1
    several_ranked = np.bincount(run, minlength=1)[run] > 1 if len(run) else new
    several, first = np.zeros(len(tokens), dtype=bool), np.zeros(len(tokens), dtype=bool)
    several[order], first[order] = several_ranked, new

    def lists(mask: np.ndarray) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[mask], minlength=len(sets)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens[mask].view(np.int64), pa.int64()))

    return np.bincount(owner[several], minlength=len(sets)), lengths, lists(~several), lists(several & first)


_SIGNED = "tag long, doc_id long, n long, k1 long, k2 long, first boolean, known long, single array<long>, witness array<long>"


def _sketch(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Per row the size and digest of its set and, once per chunk and set, its prefix split by :func:`split_shared`."""
    for given in batches:
        for at in range(0, given.num_rows, CHUNK):
            part = given.slice(at, CHUNK)
            n, k1, k2, first, prefixes, seen = [], [], [], [], [], set()
            for t in part.column(2):
                s = ngrams(t.as_buffer().to_pybytes() if t.is_valid else b"", words)
                digest = blake2b(s.tobytes(), digest_size=16).digest()
                fresh = len(s) > 0 and digest not in seen
                seen.add(digest)
                n.append(len(s))
                k1.append(int.from_bytes(digest[:8], "big", signed=True))
                k2.append(int.from_bytes(digest[8:], "big", signed=True))
                first.append(fresh)
                prefixes.append(s[: prefix_length(len(s), percent)] if fresh else s[:0])
            known, _, single, witness = split_shared(prefixes)
            arrays = [part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in (n, k1, k2)], pa.array(first), pa.array(known, pa.int64()), single, witness]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _SIGNED.split(", ")])


def _full(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Per document its whole set, also split by :func:`split_shared`."""
    for given in batches:
        for at in range(0, given.num_rows, CHUNK):
            part = given.slice(at, CHUNK)
            sets = [ngrams(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in part.column(1)]
            known, lengths, single, witness = split_shared(sets)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            tokens = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *sets]).view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lengths, pa.int64()), tokens, pa.array(known, pa.int64()), single, witness],
                names=["cls", "n", "tokens", "known", "single", "witness"],
            )


def shared_tokens(sets: DataFrame, code: str) -> DataFrame:
    """code and ``_found``: how many of its chunk-wise single tokens another code has, too.

    What a chunk shares is settled in the chunk and sends one witness, so a token has at
    most one row per chunk here, however many documents hold it.
    """
    rows = sets.select(F.col(code).alias("_code"), F.explode("single").alias("_h")).unionByName(
        sets.select(F.lit(-1).cast("long").alias("_code"), F.explode("witness").alias("_h"))
    )
    same = Window.partitionBy("_h")
    seen = rows.withColumn("_low", F.min("_code").over(same)).withColumn("_high", F.max("_code").over(same))
    return seen.where("_code >= 0 AND _low <> _high").groupBy(F.col("_code").alias(code)).agg(F.count(F.lit(1)).alias("_found"))


def _needed(n: Column, m: Column, percent: int) -> Column:
    """Tokens that sets of these sizes must share."""
    return F.ceil((n + m) * percent / (100 + percent))


def _up(numerator: Column, by: int) -> Column:
    return F.ceil(numerator / F.lit(by))


def _similar(a: str, b: str, na: str, nb: str, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("long")
    return 100 * both >= percent * (F.col(na) + F.col(nb) - both)


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """Every row with its group of near copies: _tag, doc_id, n_shingles, component_id, kept.

    A text's set holds its distinct word n-grams (lower case for A-Z, words parted by
    ASCII white space; fewer words than n make one). Rows link when 100 |A and B| >=
    percent |A or B|; component_id is the smallest doc_id reachable. All links count:

    1. Rows with equal sets are one class; the rest works on classes.
    2. Partners share ``reserve(n)`` of the first ``prefix_length(n)`` tokens by hash.
       Classes that share too few with anyone are done, and what is left must share
       ``percent`` of its whole set with the others.
    3. Every class is compared with one class: the most central holder (its tokens have the
       most holders on average) of most of its tokens. Components of these links are the
       similar documents, cut into groups of about 64 of like sizes; the token-group matrix
       holds each group's union.
    4. Tokens are ordered from rare to frequent. The first token that partners share leaves
       both enough tokens to reach what sets of their sizes must share; so a class is a query
       to the groups of larger components that hold such a token. It shares with
       no member more than with the group's union: only groups whose union holds enough of the
       query are opened, member by member.

    Hot tokens, copies and groups are settled by map-side work, minima and components, so no
    group's pairs are listed; a task keeps one chunk or one group of 64 at a time.

    Texts that are null, empty or blank have no set and are alone, each with its own id. Null
    ids do not name a component (null if all are). Of a component the row with the smallest
    id is ``kept`` (null last, then by tag), also among repeated rows. An empty table
    gives no rows; other columns are not read.
    """
    lowest = -(-percent * 1000 // 100)  # a partner's size is at least percent of one's own, in thousandths
    docs = settled(docs)
    given = tagged(docs, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    sketches = materialize(given.select("_tag", "doc_id", "text").mapInArrow(partial(_sketch, words=words, percent=percent), _SIGNED), "sketches")
    rows = sketches.select("tag", "doc_id", "n", "k1", "k2", "first")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag"))
    classes = rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min("tag").alias("cls"), F.max("n").alias("n"), least.alias("least"), F.count(F.lit(1)).alias("copies"), F.sum(F.col("first").cast("long")).alias("chunks")
    )
    classes = materialize(classes.withColumn("code", F.col("k1").bitwiseAND(F.lit(CODE))), "classes")

    # 2. classes that share enough of their prefix
    holders = sketches.where("first").withColumn("code", F.col("k1").bitwiseAND(F.lit(CODE)))
    found = shared_tokens(holders.select("code", "single", "witness"), "code")
    known = holders.where("known > 0").groupBy("code").agg(F.sum("known").alias("_known"))
    counted = classes.join(found, "code", "left").join(known, "code", "left")
    total = F.coalesce("_found", F.lit(0)) + F.coalesce("_known", F.lit(0))
    small = F.ceil(F.col("n") * lowest / 1000)
    needed = F.greatest(F.lit(1), _up(small, 10))
    alive = materialize(counted.where(total >= needed * F.col("chunks")).select("cls", "code"), "alive")

    # whole sets of these; a bounded table of buckets keeps most other texts out of the shuffle
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).alias("_bucket")
    near = given.select("_tag", "text", bucket("_tag")).join(F.broadcast(alive.select(bucket("cls")).distinct()), "_bucket", "left_semi")
    texts = near.join(alive.select(F.col("cls").alias("_tag"), "code").hint("shuffle_hash"), "_tag").select("_tag", "text")
    whole = materialize(texts.mapInArrow(partial(_full, words=words), "cls long, n long, tokens array<long>, known long, single array<long>, witness array<long>"), "sets")
    again = whole.select("cls", "n", "known").join(shared_tokens(whole, "cls"), "cls", "left")
    enough = again.where(F.col("known") + F.coalesce("_found", F.lit(0)) >= F.ceil(F.col("n") * percent / 100)).select("cls")
    sets = materialize(whole.select("cls", "n", "tokens").join(enough.hint("shuffle_hash"), "cls", "left_semi"), "sets")

    # 3. links to the most central holder of most tokens
    tokens = sets.select("cls", "n", F.explode("tokens").alias("h"))
    spread = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = materialize(tokens.join(spread, "h"), "tokens")
    centrality = held.groupBy("cls").agg((F.sum("df") / F.max("n")).alias("weight"))
    central = held.select("cls", "h").join(centrality, "cls").groupBy("h").agg(F.max_by("cls", F.struct("weight", "cls")).alias("anchor"))
    votes = held.select("cls", "h").join(central, "h").where("anchor <> cls").groupBy("cls", "anchor").agg(F.count(F.lit(1)).alias("votes"))
    stars = votes.groupBy("cls").agg(F.max_by("anchor", F.struct("votes", "anchor")).alias("anchor"))
    links = materialize(_verified(stars.select(F.col("cls").alias("a"), F.col("anchor").alias("b")), sets, percent), "links")
    roots = components(links)

    # 4. first tokens, rare to frequent, that classes of several components hold; ``room``
    # is how many tokens a class has from this one on, so a partner shares no more if it is the first shared one
    mine = Window.partitionBy("cls")
    first = held.withColumn("_place", F.row_number().over(mine.orderBy("df", "h"))).withColumn("_shared", F.count(F.lit(1)).over(mine))
    first = first.withColumn("room", F.col("_shared") - F.col("_place") + 1).where(F.col("room") >= F.ceil(F.col("n") * percent / 100))

    def rooted(df: DataFrame) -> DataFrame:
        return df.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))

    every = rooted(sets.select("cls", "n"))
    counts = every.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    # a group: up to about MEMBERS classes of one component, of sizes within an eighth
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("size") / MEMBERS))
    every = every.join(counts, "root").select("cls", "size", "root", part.alias("part"), F.floor(F.log("n") * 8).alias("span"), "n")
    group = ["size", "root", "part", "span"]
    grouped = materialize(first.select("cls", "h", "room").join(every, "cls"), "first")
    several = grouped.groupBy("h").agg(F.min("root").alias("_a"), F.max("root").alias("_z")).where("_a <> _z").select("h")
    queries = materialize(grouped.join(several, "h"), "queries")
    matrix = queries.groupBy("h", *group).agg(F.min("n").alias("low"), F.max("room").alias("group_room"))
    matrix = matrix.withColumnsRenamed({c: f"group_{c}" for c in group})
    needed = _needed(F.col("n"), F.col("low"), percent)
    asked = queries.select("cls", "h", "size", "root", "n", "room").join(matrix, "h")
    larger = F.struct("group_size", "group_root") > F.struct("size", "root")
    asked = asked.where(larger & (F.col("room") >= needed) & (F.col("group_room") >= needed))
    asked = materialize(asked.select("cls", *[F.col(f"group_{c}").alias(c) for c in group]).distinct(), "asked")
    members = every.join(asked.select(*group).distinct(), group, "left_semi")
    unions = members.select("cls", *group).join(sets, "cls").groupBy(*group).agg(
        F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"), F.min("n").alias("low")
    )
    bound = F.size(F.array_intersect("tokens", "union")) >= _needed(F.col("n"), F.col("low"), percent)
    qualifying = asked.join(sets, "cls").join(unions, group).where(bound).select(F.col("cls").alias("a"), *group)
    pairs = qualifying.join(members.select(F.col("cls").alias("b"), *group), group).select("a", "b")
    links = links.unionByName(_verified(pairs, sets, percent))
    roots = components(links)

    # back to all rows
    named = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    heads = named.groupBy("root").agg(F.min("least").alias("head"), F.sum("copies").alias("rows")).where("rows > 1")
    joined = named.select("k1", "k2", "root").join(heads, "root").select("k1", "k2", "head")
    return rows.join(joined.hint("shuffle_hash"), ["k1", "k2"], "left").select(
        F.col("tag").alias("_tag"),
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("head").isNull() | (F.col("n") == 0), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.coalesce((F.col("head.tag") == F.col("tag")) | (F.col("n") == 0), F.lit(True)).alias("kept"),
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"), F.col("n").alias("na"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"), F.col("n").alias("nb"))
    fitting = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & _similar("ta", "tb", "na", "nb", percent)
    return pairs.join(left, "a").join(right, "b").where(fitting).select("a", "b")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of near copies, with all columns."""
    docs = settled(docs)
    return without(docs, jaccard_components(docs, doc_id, text).where("NOT kept"))


def query(spark, sf_dir):
    """All documents with their near-copy component."""
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
