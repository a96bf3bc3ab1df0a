"""Phrase collocations counted over a prefix-free parse of the corpus."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graticule.llm.common import table
from graticule.session import materialize

BREAK = b"."  # stands between pieces; never a word, as pieces are split there
SEPARATORS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
HELD = 16 << 20  # bytes of text parsed within a task before its chunks are sent on
KEYS = 500_000  # words of chunks whose phrases are counted together within a task
BITS = 1 << 26  # of the table of frequent phrases: 8 MB, whatever the corpus
_STEP = 0x9E3779B97F4A7C15  # odd; its powers weigh the words of a window
_SEED = 42  # of Spark's own xxhash64


def symbols(raw: bytes) -> list[bytes]:
    """Words in lower case (A-Z), pieces parted by ``BREAK``."""
    return raw.lower().translate(SEPARATORS).replace(BREAK, b" . ").split()


def triggers(words: list[bytes], overlap: int, modulus: int) -> np.ndarray:
    """Places where a window of ``overlap`` words starts a chunk: its hash alone decides."""
    from xxhash import xxh3_64_intdigest

    n = len(words) - overlap + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64)
    codes = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    h = np.zeros(n, dtype=np.uint64)
    for i in range(overlap):
        h += codes[i : i + n] * np.uint64(pow(_STEP, i + 1, 1 << 64))
    h ^= h >> np.uint64(32)
    return np.flatnonzero(h % np.uint64(modulus) == 0)


def chunks(words: list[bytes], overlap: int, modulus: int) -> Iterator[tuple[bytes, int]]:
    """Chunks from trigger to trigger with the next trigger window, and how many of a chunk's words the next one has again.

    Every phrase of up to ``overlap + 1`` words starts before the repeated words of exactly one chunk, and lies in it.
    """
    cuts = [0, *[i for i in triggers(words, overlap, modulus).tolist() if i], len(words)]
    for start, end in zip(cuts, cuts[1:]):
        last = end == len(words)
        if end > start:
            yield b" ".join(words[start : end if last else end + overlap]), 0 if last else overlap


class Tally:
    """Counts per language and key, given out in batches of bounded size."""

    def __init__(self, names: list[str]):
        self.names, self.counts = names, {}

    def add(self, lang: str, keys: Iterable, times: Iterable[int]) -> None:
        """Keys (chunks with what the next one has again) and how often each occurs."""
        counts = self.counts.setdefault(lang, {})
        for key, n in zip(keys, times):
            counts[key] = counts.get(key, 0) + n

    def batch(self) -> pa.RecordBatch:
        keys = [k for counts in self.counts.values() for k in counts]
        langs = pa.array([lang for lang, counts in self.counts.items() for _ in counts], pa.string())
        texts, again = list(zip(*keys)) or [(), ()]
        out = [langs, pa.array(texts, pa.binary()).cast(pa.string()), pa.array(again, pa.int32())]
        out.append(pa.array([n for counts in self.counts.values() for n in counts.values()], pa.int64()))
        self.counts = {}
        return pa.RecordBatch.from_arrays(out, names=self.names)


def _parse(batches: Iterator[pa.RecordBatch], overlap: int, modulus: int) -> Iterator[pa.RecordBatch]:
    """Chunks of all texts with how often they occur, as far as a task holds them together."""
    tally = Tally(["lang", "chunk", "again", "times"])
    held = 0
    for given in batches:
        for lang, t in zip(given.column(0).to_pylist(), given.column(1)):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            tally.add(lang, chunks(symbols(raw), overlap, modulus), repeat(1))
            held += len(raw)
            if held > HELD:
                yield tally.batch()
                held = 0
    yield tally.batch()


def seed_of(lang: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(lang.encode(), _SEED)


def hashes(words: Iterable[bytes], lang: str, count: int) -> np.ndarray:
    """The hash of each word of a language, the same as Spark's."""
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words, repeat(seed_of(lang))), dtype=np.uint64, count=count)


def longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one word more: the phrase's turned by 7 bits, combined with the word's."""
    return (h << np.uint64(7) | h >> np.uint64(57)) ^ word


def places(phrases: Iterable[bytes], lang: str, count: int) -> np.ndarray:
    """The bits of phrases in the table, the same as Spark's."""
    words = [p.split(b" ") for p in phrases]
    found = np.zeros(count, dtype=np.uint64)
    for i, w in enumerate(words):
        for h in hashes(w, lang, len(w)):
            found[i] = longer(found[i], h)
    return (found % np.uint64(BITS)).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Chunks put together until they have ``KEYS`` words or more."""
    kept, held = [], 0
    for given in batches:
        kept.append(given)
        held += given.num_rows + (pc.sum(pc.count_substring(given.column(1), " ")).as_py() or 0)
        if held >= KEYS:
            yield pa.Table.from_batches(kept).combine_chunks()
            kept, held = [], 0
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def _weighed(chunk: pa.Array, again: np.ndarray, times: np.ndarray, lang: str, size: int, tables: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """Distinct phrases of ``size`` words in the chunks of a language, and the weights of the places where they start.

    Words are numbers from the first look at the text on: each distinct one is hashed once
    and each distinct phrase written out once, however often they occur.
    """
    split = pc.split_pattern(chunk, " ")
    coded = split.flatten().dictionary_encode()
    words, names = np.asarray(coded.indices).astype(np.int64), coded.dictionary
    lengths = np.asarray(pc.list_value_length(split))
    end = np.repeat(np.cumsum(lengths), lengths)
    at, n = np.arange(len(words)), len(words)
    starts = words != pc.index(names, BREAK.decode()).as_py()
    if size > 1:
        word = hashes(names.cast(pa.binary()).to_pylist(), lang, len(names))[words]
        h = word.copy()
    for width in range(1, size):
        # starts: the ``width`` words from here on may be a frequent phrase
        bits = (h % np.uint64(BITS)).astype(np.int64)
        starts &= (tables[width - 1][bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)
        starts[:-1] &= starts[1:]
        starts &= at + width < end
        h[: n - width] = longer(h[: n - width], word[width:])
    # words that the next chunk has again start no phrase here
    found = np.flatnonzero(starts & (at < end - np.repeat(again, lengths)))
    phrase, phrases = words[found], names
    for width in range(1, size):
        pairs = pa.array(phrase * len(names) + words[found + width]).dictionary_encode()
        known = np.asarray(pairs.dictionary)
        phrase = np.asarray(pairs.indices).astype(np.int64)
        phrases = pc.binary_join_element_wise(phrases.take(pa.array(known // len(names))), names.take(pa.array(known % len(names))), " ")
    weights = np.bincount(phrase, weights=np.repeat(times, lengths)[found], minlength=len(phrases)).astype(np.int64)
    return (phrases, weights) if weights.all() else (phrases.filter(pa.array(weights > 0)), weights[weights > 0])


def _count(batches: Iterator[pa.RecordBatch], size: int, frequent: list) -> Iterator[pa.RecordBatch]:
    """Phrases of ``size`` words in distinct chunks, each chunk weighing as often as it occurs.

    ``frequent`` has a broadcast table of the frequent phrases per smaller size: a phrase
    can be frequent only if those within it are.
    """
    tables = [np.frombuffer(b.value, dtype=np.uint8) for b in frequent]
    for given in _gathered(batches):
        for lang in pc.unique(given.column(0)).to_pylist():
            mine = given.filter(pc.equal(given.column(0), lang)).combine_chunks()
            if mine.num_rows:
                chunk, again, times = (mine.column(i).chunk(0) for i in (1, 2, 3))
                phrases, weights = _weighed(chunk, np.asarray(again), np.asarray(times), lang, size, tables)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(weights)], names=["lang", "phrase", "n"])


def _table_of(counts: DataFrame) -> bytes:
    """One bit per hash of a phrase: built by map-side unions, ``BITS`` bits whatever is counted."""
    turned = lambda h: F.shiftleft(h, 7).bitwiseOR(F.shiftrightunsigned(h, 57))
    whole = F.aggregate(F.split("phrase", " "), F.lit(0).cast("long"), lambda h, word: turned(h).bitwiseXOR(F.xxhash64("lang", word)))
    place = F.pmod(whole, F.lit(BITS))
    page = 1 << 15  # bits of one bitmap aggregate
    pages = counts.select(F.floor(place / page).alias("page"), (place % page).alias("bit")).groupBy("page")
    out = bytearray(BITS // 8)
    for row in pages.agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[row["page"] * page // 8 : (row["page"] + 1) * page // 8] = row["bits"]
    return bytes(out)


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, least: int = 10, modulus: int = 16) -> tuple[DataFrame, DataFrame]:
    """Phrases of up to ``longest`` words that occur ``least`` times (lang, words, phrase, n), and all words per language (lang, n).

    1. Parse: a window of ``longest - 1`` words whose hash is 0 modulo ``modulus`` ends a
       chunk and starts the next, so equal passages give equal chunks wherever they stand.
       The dictionary holds each distinct chunk once with its frequency.
    2. Phrases are counted in the dictionary, weighted by that frequency, at the one chunk
       where they start before the overlap. Longer phrases are looked at only where the
       shorter ones within them may be frequent, by a table of ``BITS`` bits; a bit shared
       by chance costs a count, never a result.

    Copied text costs nothing after the parse; a frequent chunk or phrase is added up in
    the tasks before it is shuffled. Texts are lower-cased in A-Z, cut into pieces at
    ``.,;:!?`` and line ends and into words at spaces and tabs; phrases lie within a piece.
    A null language is ``und``; null, empty and blank texts have no words; repeated rows
    count again; an empty table gives no rows; other columns are not read.
    """
    given = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    parsed = given.mapInArrow(partial(_parse, overlap=longest - 1, modulus=modulus), "lang string, chunk string, again int, times long")
    dictionary = materialize(parsed.groupBy("lang", "chunk", "again").agg(F.sum("times").alias("times")), "dictionary")
    context = docs.sparkSession.sparkContext
    frequent, found, totals = [], [], None
    for size in range(1, longest + 1):
        counted = dictionary.mapInArrow(partial(_count, size=size, frequent=list(frequent)), "lang string, phrase string, n long")
        counted = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        if size == 1:
            counted = materialize(counted, "words")
            totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
        counted = counted.where(F.col("n") >= least).select("lang", F.lit(size).alias("words"), "phrase", "n")
        found.append(materialize(counted, "phrases") if size > 1 else counted)
        if size < longest:
            frequent.append(context.broadcast(_table_of(found[-1])))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, totals


def _part(start: int, end: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, end), " ")


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, least: int = 10, covered: int = 50, top: int | None = 2000, modulus: int = 16
) -> DataFrame:
    """Phrases whose words stand together more often than alone: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``longest`` words that occurs a >= ``least`` times is cut after each of
    its words but the last; with l and r the counts of both parts, the cut of the lowest
    floor(1,000,000 a a / (l r)) counts (the first one of equal ones). Products are exact
    decimals of 38 digits, enough for 10**15 occurrences. A phrase goes if a longer
    candidate around it has ``covered`` percent of its occurrences or more. ``n`` is the
    number of words of the language; the ``top`` of each language stay (None: all), by
    score, then a (both descending), then phrase. Ties end there, as phrases differ.

    Edge cases as in :func:`phrase_counts`.
    """
    counts, totals = phrase_counts(docs, lang, text, longest, least, modulus)
    candidates = counts.where("words > 1")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), "cut", _part(1, F.col("cut")).alias("left"), F.array_join(F.slice(F.split("phrase", " "), F.col("cut") + 1, F.col("words")), " ").alias("right"))
    parts = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    cuts = cuts.join(parts, ["lang", "left"]).join(parts.withColumnsRenamed({"left": "right", "l": "r"}), ["lang", "right"])
    exact = {c: F.col(c).cast("decimal(16,0)") for c in "alr"}
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (exact["a"] * exact["a"]), exact["l"] * exact["r"])
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    # the longer candidate with one word more has the most occurrences of all around a phrase
    longer = candidates.where("words > 2").select("lang", "n", F.explode(F.array(_part(1, F.col("words") - 1), _part(2, F.col("words") - 1))).alias("phrase"))
    around = longer.groupBy("lang", "phrase").agg(F.max("n").alias("around"))
    kept = best.join(around, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < covered * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # the best of each of many parts first, so that no task sorts a whole language
        kept = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir):
    """The 2,000 best collocations of every language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) AS sizes(k)),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM starts),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, k, a, w, cut, array_to_string(w[1:cut], ' ') AS p1, array_to_string(w[cut + 1:], ' ') AS p2
  FROM candidates, (VALUES (1), (2)) AS c(cut) WHERE cut < k),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = p1 JOIN counts y ON y.lang = cuts.lang AND y.phrase = p2),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, part, max(a) AS most
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN around ON around.lang = best.lang AND around.part = best.phrase
  WHERE most IS NULL OR 100 * most < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals ON totals.lang = kept.lang
QUALIFY rank <= 2000
"""
