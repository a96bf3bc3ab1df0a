from __future__ import annotations

import itertools
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graticule.llm.sharding import curve_tables, hilbert_index, hilbert_shards, quantised


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(spark, dims, bits):
    cells = spark.createDataFrame(list(itertools.product(range(1 << bits), repeat=dims)), [f"c{i}" for i in range(dims)])
    rows = cells.withColumn("at", hilbert_index([F.col(f"c{i}") for i in range(dims)], bits)).orderBy("at").collect()
    assert [r["at"] for r in rows] == list(range(1 << (dims * bits)))
    assert all(sum(abs(a - b) for a, b in zip(x[:-1], y[:-1])) == 1 for x, y in zip(rows, rows[1:]))


def test_tables_cover_states():
    digits, states = curve_tables(3)
    assert len(digits) == len(states) == 24 * 8 and max(states) < 24


def check(rows, given, shards):
    assert len(rows) == len(given)
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values(), default=0) - min((counts[s] for s in range(shards)), default=0) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in given)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    order = [r["curve"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


def test_odd_rows(docs_of, odd_rows):
    check(hilbert_shards(docs_of(odd_rows), ["source", "lang", "n_chars"], 4).collect(), odd_rows, 4)


def test_hot_value_and_pruning(docs_of):
    rows = [(i, f"t{i}", "en" if i % 2 else "fr", "hot" if i % 3 else f"s{i % 40:02}", i % 97) for i in range(900)]
    got = hilbert_shards(docs_of(rows), ["source", "lang", "n_chars"], 8).collect()
    check(got, [r[:2] for r in rows], 8)
    spread = [max(r["dim_2"] for r in got if r["shard"] == s) - min(r["dim_2"] for r in got if r["shard"] == s) for s in range(8)]
    assert sum(spread) < 8 * 96  # some shards leave out part of the lengths


def test_empty(docs_of):
    assert hilbert_shards(docs_of([]), ["source", "n_chars"]).collect() == []


@pytest.mark.parametrize("hot", [1, 400])
def test_string_levels_are_quantiles_of_whole_values(docs_of, hot):
    """Values that differ far behind a common beginning, one that begins otherwise, nulls and a hot value."""
    values = sorted(["ftp://a"] + [f"https://a.very.long.common.beginning/{i:02}é" for i in range(40)], key=str.encode)
    rows = [(0, "t", "en", v, 1) for i, v in enumerate(values) for _ in range(hot if i == 20 else 1)] + [(0, "t", "en", None, 1)]
    df = docs_of(rows)
    level = {r["source"]: r["level"] for r in df.select("source", quantised(df, ["source"])[0].alias("level")).distinct().collect()}
    n = {v: sum(r[3] == v for r in rows) for v in values}
    total, upto, marks, at = len(rows) - 1, 0, [], 1
    for v in values:
        upto += n[v]
        if at < 32 and upto * 32 >= at * total:
            marks.append(v.encode())
            at = upto * 32 // total + 1
    assert level == {v: sum(m < v.encode() for m in marks) for v in values} | {None: 0}
    assert hot > 1 or len(set(level.values())) == 32
