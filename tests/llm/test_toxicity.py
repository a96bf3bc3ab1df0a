from __future__ import annotations

import random

import pytest

from graticule.llm import toxicity as tox

BAD = ["scum", "moron", "vequoir", "vequla", "trash"]


@pytest.fixture(scope="module")
def corpus(prose):
    """Odd ids are toxic in a third of cases: one or two bad words among ordinary ones."""
    r = random.Random(4)
    rows, labels = [], []
    for i in range(700):
        words = prose(i, r.randint(30, 150)).split()
        toxic, poor = i % 5 == 1, i % 7 == 3
        for _ in range(r.randint(1, 3) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(BAD))
        if poor:
            words = [w.upper() + "!!" for w in words[:10] * 6]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not poor), int(toxic and not poor)))
    return rows, labels


@pytest.fixture(scope="module")
def chain(spark, docs_of, corpus):
    rows, labels = corpus
    return tox.train(docs_of(rows[:500]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out(docs_of, corpus, chain):
    rows, labels = corpus
    got = {r["doc_id"]: r for r in tox.toxicity(docs_of(rows[500:]), chain).collect()}
    truth = {d: bool(t) for d, _, t in labels[500:]}
    hits = sum(got[d]["rejected"] for d, t in truth.items() if t)
    false = sum(got[d]["rejected"] for d, t in truth.items() if not t)
    assert hits >= 0.95 * sum(truth.values()) and false <= 2
    low = [d for d, q, _ in labels[500:] if not q]
    assert sum(got[d]["p_low_quality"] > 0.5 for d in low) >= 0.95 * len(low)


def test_spark_equals_plain(docs_of, corpus, odd_rows, chain):
    got = sorted((r["doc_id"] or -1, r["p_toxic"], r["rejected"]) for r in tox.toxicity(docs_of(odd_rows), chain).collect())
    want = sorted((d or -1, chain.probabilities(t)[-1], chain.probabilities(t)[-1] >= chain.thresholds[-1]) for d, t in odd_rows)
    assert got == want


def test_later_links_use_earlier_ones(chain):
    assert [len(link.dense) for link in chain.links] == [tox.SHAPES, tox.SHAPES + 1]


def test_drop_keeps_columns(docs_of, corpus, chain):
    df = docs_of(corpus[0][:60])
    got = tox.drop_toxic(df, chain)
    assert got.columns == df.columns
    assert got.count() == tox.toxicity(df, chain).where("NOT rejected").count()


def test_without_labels(spark, docs_of, odd_rows):
    none = spark.createDataFrame([(1, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    chain = tox.train(docs_of(odd_rows), none)
    assert tox.toxicity(docs_of(odd_rows), chain).where("rejected OR p_toxic > 0.001").collect() == []
    assert tox.toxicity(docs_of([]), chain).collect() == []
    assert tox.drop_toxic(docs_of([]), chain).collect() == []


def test_a_repeated_id_is_fetched_once(spark):
    docs = spark.range(50_000).selectExpr("1L AS doc_id", "concat('b', id) AS text").unionByName(spark.createDataFrame([(1, None), (2, "x"), (3, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    rows, shares = tox.labelled_sample(docs, labels, {"toxic": labels["toxic"]}, "doc_id", "text", 2)
    assert rows == [(1, "b0", [0]), (2, "x", [1]), (3, None, [0])]
    assert shares == [1 / 3]
