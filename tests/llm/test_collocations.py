from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from checks.verify import connect, difference
from graticule.llm import collocations as c

SF = "/root/testdata/sf0.001"


def brute(given, longest=3, least=10, covered=50, top=2000):
    """All rows from counts of all phrases."""
    counts = Counter()
    for lang, text in given:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", "".join(x.lower() if x.isascii() else x for x in text or "")):
            w = re.findall(r"[^ \t]+", piece)
            counts.update((lang or "und", tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = set()
    for lang in {k[0] for k in counts}:
        n = sum(v for (g, w), v in counts.items() if g == lang and len(w) == 1)
        found = {w: v for (g, w), v in counts.items() if g == lang and len(w) > 1 and v >= least}
        rows = []
        for w, a in found.items():
            around = [v for x, v in found.items() if len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x)))]
            if not any(100 * v >= covered * a for v in around):
                cuts = [(10**6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
        out |= {(lang, r, p.decode(), -a, left, right, n, -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)}
    return out


def texts(seed, rows):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Über", "ÜBER", "A", "a", "...", "x!y", "\n"]
    line = "the quick brown fox jumps over it"
    return [(r.choice(["en", "de", None, "und"]), " ".join(r.choices(words, k=r.randint(0, 60))) + (line if r.random() < 0.4 else "\t")) for _ in range(rows)]


def frame(spark, given, parts=3):
    df = spark.createDataFrame([(*g, "x", 1) for g in given], "lang string, text string, phrase string, n int")
    return df.repartition(parts) if given else df


@pytest.mark.parametrize("modulus", [2, 16])
@pytest.mark.parametrize("longest, least", [(3, 10), (4, 3)])
def test_against_all_phrases(spark, modulus, longest, least):
    given = texts(longest, 120) + [("en", "one two three"), (None, None), ("en", ""), ("en", " \t ")] + [("en", "repeated row here again")] * 30
    got = c.collocations(frame(spark, given), longest=longest, least=least, modulus=modulus)
    assert {tuple(r) for r in got.collect()} == brute(given, longest, least)


def test_top_and_ties(spark):
    """Equal scores and counts are told apart by the phrase's bytes."""
    given = [("en", f"k{i} m{i}") for i in range(70) for _ in range(10)] + [("en", "é ü")] * 10
    for top in (1, 40, None):
        got = {tuple(r) for r in c.collocations(frame(spark, given), top=top).collect()}
        assert got == brute(given, top=top)


def test_chunks_hold_every_phrase_once():
    r = random.Random(1)
    for _ in range(50):
        words = [str(r.randint(0, 3)).encode() for _ in range(r.randint(0, 200))]
        for overlap, modulus in ((2, 3), (3, 2), (2, 1)):
            got = Counter()
            for chunk, again in c.chunks(words, overlap, modulus):
                w = chunk.split(b" ")
                got.update(tuple(w[i : i + k]) for k in range(1, overlap + 2) for i in range(len(w) - again) if i + k <= len(w))
            assert got == Counter(tuple(words[i : i + k]) for k in range(1, overlap + 2) for i in range(len(words) - k + 1))


def test_same_passage_same_chunks():
    r = random.Random(2)
    passage = [f"p{i}".encode() for i in range(400)]
    around = [[f"{k}{r.random()}".encode() for _ in range(50)] for k in range(2)]
    a, b = (set(c.chunks(x + passage + x, 2, 16)) for x in around)
    assert len(a & b) >= 10


def test_place_is_the_one_of_spark(spark):
    df = spark.createDataFrame([("en", "é a"), ("und", "x" * 100)], "lang string, phrase string")
    table = c._table_of(df)
    assert sum(bin(b).count("1") for b in table) == 2
    for lang, phrase in (("en", "é a"), ("und", "x" * 100)):
        (at,) = c.places([phrase.encode()], lang, 1).tolist()
        assert table[at >> 3] >> (at & 7) & 1


def test_flushes(spark, monkeypatch):
    given = texts(9, 60)
    monkeypatch.setattr(c, "HELD", 500)
    monkeypatch.setattr(c, "KEYS", 20)
    assert {tuple(r) for r in c.collocations(frame(spark, given), least=3).collect()} == brute(given, least=3)


def test_very_long_text_and_large_counts(spark):
    given = [("en", "a b " * 50_000), ("en", "z" * 100_000)]
    got = {tuple(r) for r in c.collocations(frame(spark, given)).collect()}
    assert got == brute(given)


def test_empty(spark):
    assert c.collocations(frame(spark, [])).collect() == []


def test_sql(spark):
    assert difference(c.query(spark, SF).toPandas(), connect(SF).execute(c.SQL).df()) is None


def test_a_phrase_is_hashed_once_however_often_it_occurs(monkeypatch):
    """Ten batches of the same chunks: each distinct word is hashed once, not once per place."""
    import pyarrow as pa
    import xxhash

    class Table:
        value = bytes([255]) * (c.BITS // 8)

    chunk = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 50), pa.array(["a b c . d"] * 50), pa.array([0] * 50, pa.int32()), pa.array([2] * 50, pa.int64())], names=["lang", "chunk", "again", "times"]
    )
    asked, hashed = [], xxhash.xxh64_intdigest
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda word, seed=0: asked.append(word) or hashed(word, seed))
    got = Counter()
    for batch in c._count(iter([chunk] * 10), 3, [Table, Table]):
        got.update(dict(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())))
    assert got == {"a b c": 1000} and len(asked) <= 5 + 1  # and once the language
