"""Near copies by SetSketch registers: banded, judged by their joint likelihood, verified on whole sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graticule.functions.sizing import settled_side
from graticule.llm.common import settled, table, tagged, without
from graticule.llm.components import components
from graticule.llm.jaccard import ngrams
from graticule.session import materialize

REGISTERS = 256
BASE = 1.1  # registers grow by one when the minimum falls by this factor
RATE = 20.0  # of the exponential distribution, so that a register of one element is above 0
TOP = 255  # registers are cut off here: sets of up to about 10**8 elements
BAND = 5  # registers of a band
CHUNK = 2000  # rows whose copies are found within a task before the shuffle
BLOCK = 4096  # elements hashed at once
BUCKETS = 1 << 20  # of the table that spares most texts a shuffle: at most 8 MB
HOT = 1024  # pairs of one document in a task
CENTRAL = 2  # rounds in which a bucket's most central class is compared
MARKS = 16  # numbers of 64 bits that tell the n-grams of two sets apart
DOUBT = 16.0  # log likelihood lost below which a pair is verified: one similar pair in 10**8 is not
_STEP = 0x9E3779B97F4A7C15  # odd; its powers, mixed, are the registers' hash functions


def _multipliers() -> np.ndarray:
    """An odd number per register, by a rule."""
    h = np.array([pow(_STEP, i + 1, 1 << 64) for i in range(REGISTERS)], dtype=np.uint64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


MULTIPLIERS = _multipliers()


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes; those of the empty set are 0.

    Each is the smallest hash of any element as an exponential variable, on a scale of
    powers of ``BASE``, cut off at 0 and ``TOP``.
    """
    low = np.full(REGISTERS, np.iinfo(np.uint32).max, dtype=np.uint32)
    if not len(elements):
        return np.zeros(REGISTERS, dtype=np.uint8)
    x = (elements ^ (elements >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(x), BLOCK):
        np.minimum(low, np.multiply.outer(MULTIPLIERS, x[at : at + BLOCK]).min(axis=1), out=low)
    least = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(least) / math.log(BASE)), 0, TOP).astype(np.uint8)


def merge(*sketches: np.ndarray) -> np.ndarray:
    """The sketch of the union: the larger of each register."""
    return reduce(np.maximum, sketches)


def cardinality(registers: np.ndarray) -> float:
    """Estimated size of the sketched set."""
    inside = np.power(BASE, -registers.astype(np.float64)).sum()
    return REGISTERS * (1 - 1 / BASE) / (RATE * math.log(BASE) * inside)


def _above(x: np.ndarray) -> np.ndarray:
    """Chance of a larger register in one of two sets, x being its share of the union that the other lacks, scaled."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def log_likelihoods(more: np.ndarray, less: np.ndarray, u: np.ndarray, similarity: np.ndarray) -> np.ndarray:
    """Of the counts of larger and smaller registers (rows), for set sizes u : 1 - u, at each similarity (columns)."""
    u, v = u[:, None], 1 - u[:, None]
    plus, minus = _above(u - v * similarity), _above(v - u * similarity)
    same = REGISTERS - more - less
    # a count of 0 asks nothing of its chance; a similarity the sizes forbid has chance 0
    parts = [np.where(n[:, None] > 0, n[:, None] * np.log(np.maximum(p, 1e-300)), 0.0) for n, p in ((more, plus), (less, minus), (same, 1 - plus - minus))]
    allowed = np.minimum(u, v) / np.maximum(u, v) + 1e-9 >= similarity
    return np.where(allowed, parts[0] + parts[1] + parts[2], -np.inf)


GRID = np.linspace(0, 1, 201)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of two register tables: the most likely similarity, and whether ``percent`` or more can be it."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    logs = log_likelihoods(more, less, na / np.maximum(na + nb, 1), np.append(GRID, percent / 100))
    best = logs.argmax(axis=1)
    high = logs[:, np.append(GRID, percent / 100) >= percent / 100 - 1e-9].max(axis=1)
    return np.append(GRID, percent / 100)[best], high >= logs.max(axis=1) - DOUBT


_SKETCHED = "tag long, doc_id long, n long, k1 long, k2 long, registers binary, bands array<long>"


def _sketch(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Per row the size and digest of its set and, once per chunk and set, its registers and bands."""
    for given in batches:
        for at in range(0, given.num_rows, CHUNK):
            part = given.slice(at, CHUNK)
            n, k1, k2, registers, bands, seen = [], [], [], [], [], set()
            for t in part.column(2):
                s = ngrams(t.as_buffer().to_pybytes() if t.is_valid else b"", words)
                digest = blake2b(s.tobytes(), digest_size=16).digest()
                fresh = len(s) > 0 and digest not in seen
                seen.add(digest)
                n.append(len(s))
                k1.append(int.from_bytes(digest[:8], "big", signed=True))
                k2.append(int.from_bytes(digest[8:], "big", signed=True))
                registers.append(sketch(s).tobytes() if fresh else None)
                bands.append(band_keys(np.frombuffer(registers[-1], dtype=np.uint8)) if fresh else None)
            arrays = [part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in (n, k1, k2)], pa.array(registers, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _SKETCHED.split(", ")])


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A number per band: its place, and its registers digit by digit, so equal numbers are equal bands."""
    count = REGISTERS // BAND
    digits = registers[: count * BAND].reshape(count, BAND).astype(np.int64)
    return (np.arange(count, dtype=np.int64) << (8 * BAND)) + digits @ (1 << (8 * np.arange(BAND, dtype=np.int64)))


def marks(elements: np.ndarray) -> np.ndarray:
    """A set's parity by place: a bit per place of ``MARKS`` numbers, turned over by each element there.

    Where two sets differ in d elements, their marks differ in d bits at most. So two sets
    of sizes n and m have no more than (n + m - differing bits) / 2 elements in common.
    """
    places = (elements * np.uint64(_STEP)) >> np.uint64(64 - (64 * MARKS).bit_length() + 1)
    odd = np.bincount(places.astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_MARKED = [f"m{i}" for i in range(MARKS)]


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for given in batches:
        sets = [ngrams(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in given.column(1)]
        offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
        tokens = np.concatenate([np.zeros(0, dtype=np.uint64), *sets]).view(np.int64)
        table = np.array([marks(s) for s in sets], dtype=np.int64).reshape(-1, MARKS)
        arrays = [given.column(0), pa.ListArray.from_arrays(offsets, pa.array(tokens, pa.int64())), *[pa.array(table[:, i]) for i in range(MARKS)]]
        yield pa.RecordBatch.from_arrays(arrays, names=["cls", "tokens", *_MARKED])


def _judge(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose registers leave ``percent`` possible, with the estimate."""
    for given in batches:
        if not given.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(given.column(i).to_pylist()), dtype=np.uint8).reshape(-1, REGISTERS) for i in (4, 5))
        na, nb = (np.asarray(given.column(i)).astype(np.float64) for i in (2, 3))
        estimate, possible = similarity(a, b, na, nb, percent)
        keep = pa.array(possible)
        yield pa.RecordBatch.from_arrays([given.column(0).filter(keep), given.column(1).filter(keep), pa.array(estimate[possible])], names=["a", "b", "estimate"])


def _with(pairs: DataFrame, side: DataFrame, key: str, other: str, few: bool) -> DataFrame:
    """``pairs`` with the columns of ``side`` for ``key``; a document of very many pairs is dealt over copies of its row.

    A few pairs, ``HOT`` at most, are sent to the rows instead.
    """
    if few:
        return side.join(F.broadcast(pairs), key)
    hot = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT)
    # few, and sent around only where they are counted to be
    hot = settled_side(hot.select(key, F.ceil(F.col("_n") / HOT).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = pairs.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(other), parts).cast("int")).drop("_parts")
    copied = side.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(copied, [key, "_part"]).drop("_part")


def _links(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough, by likelihood first and then on whole sets: a, b, estimate."""
    a = sketches.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    b = sketches.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))
    few = pairs.count() <= HOT
    beside = _with(_with(pairs, b, "b", "a", few), a, "a", "b", few).where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    likely = beside.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(partial(_judge, percent=percent), "a long, b long, estimate double")
    likely = materialize(likely, "likely")
    a = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    few = likely.count() <= HOT
    whole = _with(_with(likely, b, "b", "a", few), a, "a", "b", few)
    both = F.size(F.array_intersect("ta", "tb")).cast("long")
    return whole.where(100 * both >= percent * (F.size("ta") + F.size("tb") - both)).select("a", "b", "estimate")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """Every row with its group of near copies: _tag, doc_id, n_shingles, component_id, kept, n_links.

    A text's set holds its distinct word n-grams (lower case for A-Z, words parted by
    ASCII white space; fewer words than n make one). Rows link when 100 |A and B| >=
    percent |A or B|; component_id is the smallest doc_id reachable.

    1. Rows of equal sets are one class, known by the tag of one of them.
    2. Each class has a SetSketch: 256 registers, mergeable by maximum. Of two sets of
       similarity J a register is the same with a chance of slightly over J. Bands of 5
       registers are compared: of pairs at 0.8, one in 10**8 has none of 51 in common.
    3. Of the classes that share a bucket with others, the n-grams that more than one of
       them has are counted: partners share no others. With s of a set of n, two sets are at
       most min(s) / (n + n - min(s)) alike; whom that rules out leaves its buckets, and
       pairs that it rules out are not made.
    4. The classes of a bucket are compared in rounds. First the most central one (its
       n-grams have the most holders on average) with all others, ``CENTRAL`` times; most
       copies of a text link to these. Then those outside the bucket's largest component
       compare themselves with the classes of other components, about 4 of them in the
       first round, sixteen times as many in each next one. Who was compared with all leaves
       the bucket; buckets of one component are done.
    5. A pair is judged by the joint likelihood of its registers, given both set sizes, and
       verified on the whole sets (as 64-bit hashes) unless it is ruled out.

    So copies of a text cost a few rows each. Texts that share nearly all n-grams with
    others, are 60 to 80 % alike and yet do not link, are all compared: banding cannot tell them
    from links. ``n_links`` counts the links verified for the class, as many as the rounds
    needed: no pair within a component is looked for.

    Texts that are null, empty or blank have no set and are alone, each with its own id. Null
    ids do not name a component (null if all are). Of a component the row with the smallest
    id is ``kept`` (null last, then by tag), also among repeated rows. An empty table
    gives no rows; other columns are not read.
    """
    docs = settled(docs)
    given = tagged(docs, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    rows = materialize(given.select("_tag", "doc_id", "text").mapInArrow(partial(_sketch, words=words), _SKETCHED), "setsketch")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag"))
    named = rows.where("n > 0").groupBy("k1", "k2").agg(
        F.min(F.when(F.col("registers").isNotNull(), F.col("tag"))).alias("cls"), least.alias("least"), F.count(F.lit(1)).alias("copies")
    )
    classes = materialize(named, "classes")
    held = rows.where("registers IS NOT NULL").join(classes.select(F.col("cls").alias("tag")).hint("shuffle_hash"), "tag", "left_semi")
    spots = held.select(F.explode("bands").alias("key"), F.col("tag").alias("cls"))
    several = spots.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    spots = materialize(spots.join(several, "key"), "buckets")

    # registers and whole sets of the classes that meet others; a bounded table of buckets keeps other texts out of the shuffle
    met = materialize(spots.select("cls").distinct(), "met")
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS)).alias("_bucket")
    near = given.select("_tag", "text", bucket("_tag")).join(F.broadcast(met.select(bucket("cls")).distinct()), "_bucket", "left_semi")
    texts = near.join(met.select(F.col("cls").alias("_tag")).hint("shuffle_hash"), "_tag", "left_semi").select("_tag", "text")
    sets = materialize(texts.mapInArrow(partial(_sets, words=words), "cls long, tokens array<long>, " + ", ".join(f"{m} long" for m in _MARKED)), "sets")
    sketches = held.select(F.col("tag").alias("cls"), "n", "registers").join(met.hint("shuffle_hash"), "cls", "left_semi")
    sketches = materialize(sketches, "registers")

    # what a class has in common with any other one
    tokens = sets.select("cls", F.explode("tokens").alias("h"))
    holders = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = tokens.join(holders, "h").groupBy("cls").agg(F.count(F.lit(1)).alias("s"), F.sum("df").alias("weight"))
    common = sketches.select("cls", "n").join(common, "cls").where(100 * F.col("s") >= percent * F.col("n"))
    common = materialize(common.withColumn("weight", F.col("weight") / F.col("n")), "common")
    spots = spots.join(common.hint("shuffle_hash"), "cls")
    smallest = spots.groupBy("key").agg(F.min("n").alias("_low"))
    able = 100 * F.col("s") >= percent * (F.col("n") + F.greatest("_low", "s") - F.col("s"))
    spots = materialize(spots.join(smallest, "key").where(able).drop("_low"), "spots")

    links, roots, tested = None, None, None
    turn, leaders = 0, 4.0
    while True:
        placed = spots.withColumn("root", F.col("cls"))
        if roots is not None:
            placed = spots.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("weight", "cls")).alias("top"))
        sizes = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"), F.max("top").alias("top")).where("n > main.n")
        sizes = sizes.select("key", (F.col("n") - F.col("main.n")).alias("apart"), F.col("main.root").alias("main"), F.col("top.cls").alias("top"))
        if turn < CENTRAL:
            leads = F.col("cls") == F.col("top")
        else:
            # the same classes lead in all their buckets, so that few pairs are new
            chance = F.xxhash64("cls", F.lit(turn)).bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
            leads = (F.col("root") != F.col("main")) & (chance * F.col("apart") < leaders)
            leaders *= 16
        placed = materialize(placed.join(sizes, "key").withColumn("leads", leads).drop("apart", "main", "top"), "round")
        if placed.isEmpty():
            break
        told, shared = [], F.least("s", "s_a")
        sides = placed
        if turn >= CENTRAL:
            # few are left by now; those whose marks differ too much are no pair, so that a family of texts that do not link makes few
            told, sides = _MARKED, placed.join(sets.select("cls", *_MARKED).hint("shuffle_hash"), "cls")
            differ = reduce(lambda x, y: x + y, [F.bit_count(F.col(m).bitwiseXOR(F.col(f"{m}_a"))) for m in _MARKED])
            shared = F.least(shared, F.floor((F.col("n") + F.col("n_a") - differ) / 2))
        first = sides.where("leads").select("key", *[F.col(c).alias(f"{c}_a") for c in ("cls", "n", "s", "root", *told)])
        fits = (F.col("root") != F.col("root_a")) & (~F.col("leads") | (F.col("cls_a") < F.col("cls"))) & (100 * shared >= percent * (F.col("n") + F.col("n_a") - shared))
        met_by = first.withColumnRenamed("key", "_key").join(sides, (F.col("_key") == F.col("key")) & fits)
        pairs = met_by.select(F.least("cls", "cls_a").alias("a"), F.greatest("cls", "cls_a").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if not pairs.isEmpty():
            tested = pairs if tested is None else tested.unionByName(pairs)
            found = materialize(_links(pairs, sketches, sets, percent), "links")
            links = found if links is None else links.unionByName(found)
            roots = components(found, roots)
        spots = placed.where("NOT leads").select("key", "cls", "n", "s", "weight")
        turn += 1

    # back to all rows
    if roots is not None:
        ends = links.select(F.col("a").alias("cls")).unionByName(links.select(F.col("b").alias("cls"))).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
        known = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").join(ends, "cls", "left")
    else:
        known = classes.withColumns({"root": F.lit(None).cast("long"), "n_links": F.lit(None).cast("long")})
    known = known.withColumn("root", F.coalesce("root", "cls"))
    heads = known.groupBy("root").agg(F.min("least").alias("head"), F.sum("copies").alias("rows")).where("rows > 1")
    joined = known.select("k1", "k2", "root", "n_links").join(heads, "root").select("k1", "k2", "head", "n_links")
    return rows.select("tag", "doc_id", "n", "k1", "k2").join(joined.hint("shuffle_hash"), ["k1", "k2"], "left").select(
        F.col("tag").alias("_tag"),
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("head").isNull() | (F.col("n") == 0), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("component_id"),
        F.coalesce((F.col("head.tag") == F.col("tag")) | (F.col("n") == 0), F.lit(True)).alias("kept"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, percent: int = 80) -> DataFrame:
    """One row of every group of near copies, with all columns."""
    docs = settled(docs)
    return without(docs, near_copies(docs, doc_id, text, words, percent).where("NOT kept"))


def query(spark, sf_dir):
    """All documents with their near-copy component by word 4-grams at 80 %."""
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
