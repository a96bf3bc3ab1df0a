"""The pipeline stage by stage against plain Python on a small table."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from graticule.llm.common import table
from graticule.llm.queries import ORACLE, QUERIES
from tests.llm.test_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    out = [table(spark, SF, "documents")]
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, out[-1], SF).write.parquet(str(folder / str(k)))
        out.append(spark.read.parquet(str(folder / str(k))))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns(stages):
    for df in stages[1:-1]:
        assert sorted(df.columns) == sorted(stages[0].columns)


def test_toxicity(stages):
    kept = dict(pairs(stages[1]))
    bad = re.compile(r"\b(scum|moron|pathetic|idiot|stupid|worthless|disgusting)\b")
    assert 0.8 * stages[0].count() < len(kept)
    assert sum(bool(bad.search(t)) for t in kept.values()) <= 2


def test_exact(stages):
    best = {}
    for d, t in pairs(stages[1]):
        key = hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", t or "").encode()).digest()
        best[key] = min(d, best.get(key, d))
    assert sorted(d for d, _ in pairs(stages[2])) == sorted(best.values())


def test_near(stages):
    assert sorted(d for d, _ in pairs(stages[3])) == sorted({c for _, _, c in brute(pairs(stages[2]))})


def test_mix_and_pack(stages):
    before, after = dict(pairs(stages[3])), pairs(stages[4])
    assert all(before[d] == t for d, t in after)
    pieces = stages[5].collect()
    per_doc = Counter()
    for r in pieces:
        per_doc[r["doc_id"]] += r["length"]
    taken = Counter(d for d, _ in after)
    total = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert per_doc == Counter({d: total[d] * n for d, n in taken.items()})


def test_registered():
    names = sorted(QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(ORACLE) <= set(names)
