"""Spelling variants by search schemes over bidirectional FM-indexes of the vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.llm.common import table
from graticule.session import cut_lineage, materialize

RUN = re.compile("[A-Za-zÀ-ÿ]+")  # fixed value: what a word is made of
EVERY = 199  # fixed value: of so many words by hash, one loses a letter
DELIMITER = "#"  # before, between and after the words of an index; no letter
SHARD = 20_000  # words of an index, about
QUERIES = 8  # times as many queries ask an index at once
HELD = 200_000  # words counted within a task before they are sent on
STRIDE = 32  # places between two stored counts of an index


def words_of(doc_id: object, text: bytes) -> Iterator[str]:
    """The text's words, A-Z in lower case; one in ``EVERY`` by hash loses a letter."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run in RUN.findall(text.lower().decode("utf-8", "replace")):
        h = zlib.crc32(run.encode(), start)
        if h % EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        yield run


def _count(batches: Iterator[pa.RecordBatch], shortest: int) -> Iterator[pa.RecordBatch]:
    tally: Counter[str] = Counter()

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(tally.keys(), pa.string()), pa.array(tally.values(), pa.int64())], names=["word", "n"])
        tally.clear()
        return out

    for given in batches:
        for doc_id, t in zip(given.column(0).to_pylist(), given.column(1)):
            if t.is_valid:
                tally.update(w for w in words_of(doc_id, t.as_buffer().to_pybytes()) if len(w) >= shortest)
            if len(tally) > HELD:
                yield batch()
    yield batch()


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5) -> DataFrame:
    """Words of ``shortest`` letters or more that occur ``least`` times or more: word, n.

    A null id counts as an empty one, a null text has no words.
    """
    given = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    counted = given.mapInArrow(partial(_count, shortest=shortest), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the length they are ranked by; the last symbol is the only 0."""
    rank, width = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        behind = np.concatenate([rank[width:] + 1, np.zeros(min(width, len(rank)), dtype=np.int64)])
        key = rank * (len(rank) + 1) + behind
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[False], key[order][1:] != key[order][:-1]])
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == len(rank) - 1:
            return order
        width *= 2


class Side:
    """The index of a text for extensions to the left: rows of the suffix array and the symbols before them."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.rows = suffix_array(text)
        before = text[self.rows - 1]
        self.before = before
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        blocks = -(-len(text) // STRIDE) + 1
        padded = np.full(blocks * STRIDE, symbols, dtype=before.dtype)
        padded[: len(before)] = before
        self.blocks = padded.reshape(blocks, STRIDE)
        counts = np.zeros((blocks, symbols + 1), dtype=np.int32)
        np.add.at(counts, (np.repeat(np.arange(blocks), STRIDE), padded), 1)
        self.counts = np.concatenate([np.zeros((1, symbols + 1), dtype=np.int32), counts.cumsum(axis=0, dtype=np.int32)[:-1]])
        self.smaller = np.concatenate([np.zeros((blocks, 1), dtype=np.int32), self.counts.cumsum(axis=1, dtype=np.int32)[:, :-1]], axis=1)

    def ranks(self, row: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the symbol, and any smaller one, stands before the first ``row`` rows."""
        block, inside = row // STRIDE, np.arange(STRIDE) < (row % STRIDE)[:, None]
        near = self.blocks[block]
        equal = self.counts[block, symbol] + ((near == symbol[:, None]) & inside).sum(axis=1)
        return equal, self.smaller[block, symbol] + ((near < symbol[:, None]) & inside).sum(axis=1)


class States:
    """Matched stretches: the query, the rows of both suffix arrays that begin with the stretch, and their number."""

    def __init__(self, query: np.ndarray, own: np.ndarray, other: np.ndarray, size: np.ndarray):
        self.query, self.own, self.other, self.size = query, own, other, size

    def __len__(self) -> int:
        return len(self.query)

    def at(self, which: np.ndarray) -> States:
        return States(self.query[which], self.own[which], self.other[which], self.size[which])

    def turned(self) -> States:
        return States(self.query, self.other, self.own, self.size)

    @staticmethod
    def joined(*parts: States) -> States:
        return States(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("query", "own", "other", "size")))


class BidirectionalIndex:
    """FM-indexes of a delimited vocabulary and of its mirror image, kept in step.

    Extending a stretch at one end narrows its rows there; the rows at the other end shrink by as
    many as have a smaller symbol in its place.
    """

    def __init__(self, words: list[str]):
        self.words = words
        text = np.frombuffer((DELIMITER + DELIMITER.join(words) + DELIMITER).encode("utf-32-le"), dtype=np.uint32)
        self.letters = np.unique(text)
        self.symbols = len(self.letters) + 1
        coded = (np.searchsorted(self.letters, text) + 1).astype(np.int16 if self.symbols < 1 << 15 else np.int32)
        self.delimiter = int(np.searchsorted(self.letters, ord(DELIMITER))) + 1
        end = np.zeros(1, dtype=coded.dtype)
        self.left = Side(np.concatenate([coded, end]), self.symbols)
        self.right = Side(np.concatenate([coded[::-1], end]), self.symbols)
        self.word_at = np.cumsum(coded == self.delimiter) - 1  # of the delimiter before it

    def code(self, words: list[str]) -> np.ndarray:
        """Symbols of the words, a row each; 0, which no word has, for letters unknown here and beyond the end."""
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.letters, flat), len(self.letters) - 1)
        out = np.zeros((len(words), int(lengths.max()) + 1), dtype=np.int64)
        out[np.arange(out.shape[1]) < lengths[:, None]] = np.where(self.letters[at] == flat, at + 1, 0)
        return out

    def extend(self, side: Side, states: States, symbol: np.ndarray) -> States:
        """The states that go on with their symbol; ``own`` rows are those of the side's own array."""
        known = symbol > 0
        states, symbol = states.at(known), symbol[known]
        low, low_less = side.ranks(states.own, symbol)
        high, high_less = side.ranks(states.own + states.size, symbol)
        out = States(states.query, side.first[symbol] + low, states.other + high_less - low_less, high - low)
        return out.at(out.size > 0)

    def branches(self, side: Side, states: States, but: np.ndarray) -> States:
        """Every state with every symbol that follows it, but for the delimiter and its own ``but``."""
        wide = states.size > self.symbols
        narrow = np.flatnonzero(~wide)
        offsets = np.cumsum(states.size[narrow]) - states.size[narrow]
        rows = np.repeat(states.own[narrow] - offsets, states.size[narrow]) + np.arange(int(states.size[narrow].sum()))
        seen = np.unique(np.repeat(narrow, states.size[narrow]) * self.symbols + side.before[rows])
        every = (np.flatnonzero(wide)[:, None] * self.symbols + np.arange(self.symbols)).ravel()
        which, symbol = np.divmod(np.concatenate([seen, every]), self.symbols)
        fits = (symbol > 0) & (symbol != self.delimiter) & (symbol != but[which])
        return self.extend(side, states.at(which[fits]), symbol[fits])

    def search(self, words: list[str], rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place among ``words``, place in the index) that differ by one letter, put in, lost or changed.

        The half a search starts with (the first one if it goes right) must match as it is;
        the delimiter at its outer end is matched next, in the other direction, and the
        other half is run through with exactly one change up to its delimiter.
        """
        ahead, back = (self.right, self.left) if rightward else (self.left, self.right)
        lengths = np.array([len(w) for w in words])
        coded = self.code(words if rightward else [w[::-1] for w in words])
        half = lengths // 2 if rightward else lengths - lengths // 2
        zero = np.zeros(len(words), dtype=np.int64)
        states = States(np.arange(len(words)), zero, zero, zero + len(self.left.rows))
        ready = []
        for i in range(int(half.max())):
            states = self.extend(ahead, states, coded[states.query, i])
            done = half[states.query] == i + 1
            ready.append(states.at(done))
            states = states.at(~done)
        exact = States.joined(*ready).turned()
        exact = self.extend(back, exact, np.full(len(exact), self.delimiter)).turned()
        changed, found = exact.at(zero[:0]), []
        for i in range(int((lengths - half).max()) + 1):
            # both are matched up to letter half + i of their word
            place = half[exact.query] + i
            wanted = coded[exact.query, np.minimum(place, coded.shape[1] - 1)]
            more = self.branches(ahead, exact, np.where(place < lengths[exact.query], wanted, self.symbols))
            inside = half[more.query] + i < lengths[more.query]
            changed = States.joined(changed, more)  # a letter put in
            ended = half[changed.query] + i >= lengths[changed.query]
            found.append(changed.at(ended))
            changed = changed.at(~ended)
            exact_inside = exact.at(place < lengths[exact.query])
            following = coded[exact_inside.query, half[exact_inside.query] + i]
            stepped = self.extend(ahead, changed, coded[changed.query, half[changed.query] + i])
            changed = States.joined(stepped, more.at(inside), exact_inside)  # a letter changed, a letter lost
            exact = self.extend(ahead, exact_inside, following)
        whole = States.joined(*found, changed)
        whole = self.extend(ahead, whole, np.full(len(whole), self.delimiter))
        rows = (whole.turned() if rightward else whole).own
        pairs = np.unique(whole.query * len(self.words) + self.word_at[self.left.rows[rows]])
        return np.divmod(pairs, len(self.words))


_NEAR = "word string, n_near long, best struct<less: long, word: string>"


def _search(shard: pa.Table) -> pa.Table:
    """For the queries of a shard, how many near words its index has and the best of them."""
    role, side, word, n = (shard.column(c).to_pylist() for c in ("role", "side", "word", "n"))
    out: list[tuple[str, int, int, str]] = []
    for rightward in (True, False):
        own = [i for i, s in enumerate(side) if s == rightward]
        kept = {word[i]: n[i] for i in own if role[i] == "index"}
        asked = [word[i] for i in own if role[i] == "query"]
        if not kept or not asked:
            continue
        index = BidirectionalIndex(list(kept))
        best: dict[str, tuple[int, str]] = {}
        count: Counter[str] = Counter()
        for q, w in zip(*(x.tolist() for x in index.search(asked, rightward))):
            mine, other = asked[q], index.words[w]
            # those that also have the first half in common are the other search's
            if rightward or mine[: len(mine) // 2] != other[: len(mine) // 2]:
                count[mine] += 1
                best[mine] = min(best.get(mine, (0, "")), (-kept[other], other))
        out += [(w, k, *best[w]) for w, k in count.items()]
    cols = list(zip(*out)) or [()] * 4
    best_of = pa.StructArray.from_arrays([pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())], names=["less", "word"])
    return pa.Table.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), best_of], names=["word", "n_near", "best"])


def _halves(length: Column) -> Column:
    """Both halves of a word of this length, as (is it the first, letters)."""
    first = F.floor(length / 2).cast("int")
    return F.array(F.struct(F.lit(True).alias("side"), first.alias("k")), F.struct(F.lit(False).alias("side"), (length - first).cast("int").alias("k")))


def _half(side: Column, k: Column) -> Column:
    return F.when(side, F.substring("word", F.lit(1), k)).otherwise(F.substring("word", F.length("word") - k + 1, k))


def near_words(words: DataFrame) -> DataFrame:
    """For the words (word, n) that have any: the number of near words and the best, by n and then code points.

    Two words of a change of one letter share the first half or the second half of either of them
    exactly. So a word is indexed under its beginnings and ends as long as the halves of a
    word one letter shorter, as long or longer have, and asks under its own two halves.
    Halves are dealt to shards by hash; each shard builds a bidirectional FM-index of its
    words and runs the search scheme over it. A half that very many words share is dealt
    over shards of its own, a part of its words asked by a part of its queries in each, so
    a shard keeps about ``SHARD`` words and ``QUERIES`` times as many queries at most.
    """
    length = F.length("word")
    sizes = F.array_distinct(F.flatten(F.array(*[_halves(length + d) for d in (-1, 0, 1)])))
    indexed = words.select("word", "n", F.explode(sizes).alias("h")).select("word", "n", "h.side", _half(F.col("h.side"), F.col("h.k")).alias("half"))
    asking = words.select("word", "n", F.explode(_halves(length)).alias("h")).select("word", "n", "h.side", _half(F.col("h.side"), F.col("h.k")).alias("half"))
    total = indexed.count()
    shards = max(1, -(-total // SHARD))
    hot = indexed.groupBy("side", "half").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > SHARD)
    hot = hot.select("side", "half", F.ceil(F.col("_n") / SHARD).cast("int").alias("parts"), F.ceil(F.col("_n") / (QUERIES * SHARD)).cast("int").alias("turns"))

    def dealt(rows: DataFrame, role: str) -> DataFrame:
        """Rows with their shards: a word of a hot half is in one part of the index in all turns, or asks all parts in one turn."""
        parts, turns = F.coalesce("parts", F.lit(1)), F.coalesce("turns", F.lit(1))
        mine = {"index": (parts, "part", turns, "turn"), "query": (turns, "turn", parts, "part")}[role]
        rows = rows.join(hot, ["side", "half"], "left").withColumn(mine[1], F.pmod(F.xxhash64("word"), mine[0]).cast("int"))
        rows = rows.withColumn(mine[3], F.explode(F.sequence(F.lit(0), mine[2] - 1)))
        place = F.xxhash64("side", "half", "part", "turn")
        return rows.select(F.lit(role).alias("role"), "side", "word", "n", F.when(F.col("parts").isNull(), F.pmod(place, F.lit(shards))).otherwise(place).alias("shard"))

    found = dealt(indexed, "index").unionByName(dealt(asking, "query")).groupBy("shard").applyInArrow(_search, _NEAR)
    best = F.min("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), (-best["less"]).alias("best_n"), best["word"].alias("best"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, times: int = 5) -> DataFrame:
    """Every word of the corpus with the spelling it stands for: word, form, root, n, n_near, form_n.

    Words: runs of Latin letters, A-Z in lower case, of ``shortest`` letters and ``least``
    occurrences or more (see :func:`vocabulary`). Near words differ by one letter put in,
    lost or changed. The form of a word is its most frequent near word (ties: the first by code
    points) if that is ``times`` as frequent at least, else null; the root is where forms
    end. As each form is ``times`` as frequent as its word, the chains are short; they are
    followed by doubling.

    Null, empty and blank texts have no words; repeated rows count again; an empty table
    gives no rows; other columns are not read.
    """
    if shortest < 4 or times < 2:
        raise ValueError("halves need two letters and forms twice the occurrences")
    words = materialize(vocabulary(docs, doc_id, text, shortest, least), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= times * F.col("n")
    near = materialize(
        near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")),
        "variants",
    )
    roots = near.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = cut_lineage(roots.join(after, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            break
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark, sf_dir):
    """All words of six letters and five occurrences with their forms."""
    return variants(table(spark, sf_dir, "documents"))
