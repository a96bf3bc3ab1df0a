from __future__ import annotations

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from graticule.llm import exact


def norm(t):
    return re.sub("[\x20\x09-\x0d]+", " ", t or "")


def test_groups(docs_of, odd_rows):
    # equal length and prefix, different ends; a hot group
    given = odd_rows + [(100 + i, "x" * 80 + str(i % 3)) for i in range(9)] + [(200 + i, "hot  text") for i in range(40)]
    got = exact.exact_groups(docs_of(given), all_hashes=True).collect()
    groups = defaultdict(list)
    for d, t in given:
        groups[hashlib.sha256(norm(t).encode()).hexdigest()].append(d)
    assert len(got) == len(given)
    for sha, ids in groups.items():
        rows = [r for r in got if r["sha256"] == sha]
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((d is None, d or 0) for d in ids)
        keep = min((d for d in ids if d is not None), default=None)
        assert {(r["keep_id"], r["group_size"]) for r in rows} == {(keep, len(ids))}
        assert [r["doc_id"] for r in rows if r["kept"]] == [keep]


def test_only_surviving_groups_are_hashed(docs_of):
    rows = exact.exact_groups(docs_of([(1, "ab"), (2, "abc"), (3, "abd"), (4, "same"), (5, "same")])).collect()
    assert {r["doc_id"] for r in rows if r["sha256"]} == {4, 5}


def test_drop(docs_of, odd_rows):
    df = docs_of(odd_rows)
    got = exact.drop_copies(df)
    assert got.columns == df.columns
    assert got.count() == len({norm(t) for _, t in odd_rows})
    assert got.where(F.col("text") == "one").select("doc_id").collect()[0][0] == 5 - 1


def test_empty(docs_of):
    assert exact.exact_groups(docs_of([])).collect() == []
    assert exact.drop_copies(docs_of([])).collect() == []
