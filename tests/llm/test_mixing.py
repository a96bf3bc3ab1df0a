from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from graticule.llm import mixing
from graticule.llm.common import settled, tagged


@pytest.fixture(scope="module")
def corpus(prose):
    rows = []
    for i in range(400):
        poor = i % 4 == 0
        text = prose(i, 20 + i % 90)
        rows.append((i, " ".join(w.upper() + "!!" for w in text.split()) if poor else text))
    return rows


@pytest.fixture(scope="module")
def model(spark, docs_of, corpus):
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    return mixing.train_domains(docs_of(corpus), labels, mixing.quality_domains(labels))


def plain_rates(t, p, weights, rounds=40):
    """The same projected gradient on arrays, kept per row."""
    gram = (p * t[:, None]).T @ p
    targets = t.sum() * np.array(weights) / sum(weights)
    r = np.ones(len(t))
    for _ in range(rounds):
        gap = (r * t) @ p - targets
        if np.abs(gap).max() <= 1e-6 * t.sum():
            break
        r = np.maximum(0, r - p @ (np.linalg.pinv(gram, rcond=1e-9) @ gap))
    return r


@pytest.mark.parametrize("weights", [(0.5, 0.5), (0.97, 0.03)])
def test_targets_are_met(docs_of, corpus, model, weights):
    got = mixing.mixture(docs_of(corpus), model, weights).orderBy("doc_id").collect()
    t = np.array([r["tokens"] for r in got], dtype=float)
    p = np.array([[r["p_good"], r["p_poor"]] for r in got])
    rates = np.array([r["rate"] for r in got])
    assert np.allclose((rates * t) @ p, t.sum() * np.array(weights), rtol=1e-4)
    assert np.allclose(rates, plain_rates(t, p, weights), atol=1e-6)
    assert (rates >= 0).all()
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in got)
    taken = np.array([r["copies"] for r in got], dtype=float)
    assert np.allclose((taken * t) @ p / t.sum(), weights, atol=0.1)


def test_rates_stop_at_zero(spark):
    """A domain that can only come from rows that another one dominates."""
    rows = [(100, 0.6, 0.4), (100, 0.4, 0.6), (50, 0.9, 0.1)] * 4
    soft = spark.createDataFrame(rows, "tokens long, p0 double, p1 double")
    steps = mixing.fit_rates(soft, [0.05, 0.95])
    rates = [r[0] for r in soft.select(mixing.rate(steps, [F.col("p0"), F.col("p1")])).collect()]
    want = plain_rates(np.array([r[0] for r in rows], float), np.array([r[1:] for r in rows]), [0.05, 0.95])
    assert np.allclose(rates, want, atol=1e-6) and min(rates) == 0


def test_mixed_scores_each_row_once(docs_of, corpus, model):
    # two evaluations in a stage were two Python workers per task, which stayed and filled the executors of the stages behind
    got = mixing.mixed(docs_of(corpus), model, (0.5, 0.5))
    assert "EvalPython" not in got._jdf.queryExecution().executedPlan().toString()


def test_mixed_repeats_rows(docs_of, corpus, model):
    df = docs_of(corpus)
    want = {r["doc_id"]: r["copies"] for r in mixing.mixture(df, model, (0.5, 0.5)).collect()}
    got = mixing.mixed(df, model, (0.5, 0.5))
    assert got.columns == df.columns
    assert Counter(r["doc_id"] for r in got.select("doc_id").collect()) == Counter({d: n for d, n in want.items() if n})


def test_odd_rows_and_no_labels(spark, docs_of, odd_rows):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = mixing.train_domains(docs_of(odd_rows), labels, mixing.quality_domains(labels))
    got = mixing.mixture(docs_of(odd_rows), model, (0.5, 0.5)).collect()
    assert len(got) == len(odd_rows) and {round(r["p_good"], 6) for r in got} == {0.5}
    assert mixing.mixture(docs_of([]), model, (0.5, 0.5)).collect() == []
    assert mixing.mixed(docs_of([]), model, (0.5, 0.5)).collect() == []


def test_rows_without_an_id_are_drawn_one_by_one(spark, docs_of, prose):
    """Null ids and one id with many texts meet a rate of a half, too."""
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for rows in ([(None, "same text") for _ in range(1000)], [(7, prose(i, 3)) for i in range(1000)]):
        df = docs_of(rows)
        model = mixing.train_domains(df, none, mixing.quality_domains(none))
        key = mixing.chance_key(F.col("doc_id"), F.col("text"), F.col("_tag"))
        half = tagged(settled(df), F.col("doc_id"), F.col("text")).select(mixing.copies(F.lit(0.5), key).alias("n"))
        assert 420 < half.agg(F.sum("n")).first()[0] < 580
        assert mixing.mixture(df, model, (0.5, 0.5)).where("copies = 1").count() == 1000
