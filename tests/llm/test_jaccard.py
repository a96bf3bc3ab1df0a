from __future__ import annotations

import random
from collections import Counter

import pytest

from graticule.llm import jaccard
from graticule.llm.components import components


def shingles(t, words=5):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(given, percent=75):
    """Component and set size per row, from all pairs."""
    sets = [shingles(t) for _, t in given]
    root = list(range(len(given)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(given):
        ids = [e for k, (e, _) in enumerate(given) if find(k) == find(i) and e is not None]
        out.append((d, len(sets[i]), d if not sets[i] else min(ids, default=None)))
    return Counter(out)


def near(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"w{r.random():.6f}" if r.random() < share else w for w in text.split())


def rows_of(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_odd_rows(docs_of, odd_rows):
    assert rows_of(jaccard.jaccard_components(docs_of(odd_rows))) == brute(odd_rows)


@pytest.mark.parametrize("chunk", [2000, 7])
def test_against_all_pairs(docs_of, prose, monkeypatch, chunk):
    """Chains of ever further copies, sets near the border, a hot group, shared passages."""
    given, k = [], 0
    for base in range(12):
        text = prose(base, 30 + 40 * base)
        for step in range(8):
            given.append((1000 - k, text))
            text = near(text, 100 * base + step, 0.02 * (step % 4 + 1))
            k += 1
    passage = prose(77, 60)
    given += [(2000 + i, prose(500 + i, 15 + i) + " " + passage) for i in range(40)]
    hot = prose(99, 120)
    given += [(3000 + i, near(hot, i, 0.01)) for i in range(60)] + [(4000 + i, near(hot, i, 0.06)) for i in range(30)]
    random.Random(5).shuffle(given)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "MEMBERS", 4)
    assert rows_of(jaccard.jaccard_components(docs_of(given))) == brute(given)


def test_one_row_of_a_group_stays(docs_of, odd_rows):
    df = docs_of(odd_rows)
    got = jaccard.drop_near_copies(df)
    assert got.columns == df.columns
    kept = Counter(r["component_id"] for r in jaccard.jaccard_components(df).where("kept").collect())
    blank = sum(1 for _, t in odd_rows if not shingles(t))
    assert got.count() == blank + len({c for (_, n, c) in brute(odd_rows) if n}) == sum(kept.values())


def test_empty(docs_of):
    assert jaccard.jaccard_components(docs_of([])).collect() == []
    assert jaccard.drop_near_copies(docs_of([])).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (200, 150), (150, 199)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 150: 150, 199: 150, 200: 150}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("few", [0, 1000])
def test_components_of_further_links(spark, monkeypatch, few):
    """Links found later join the components known, and the earlier ones are not looked at again."""
    from graticule.llm import components as c

    looked, plain = [], c.cut_lineage
    monkeypatch.setattr(c, "FEW", few)
    monkeypatch.setattr(c, "cut_lineage", lambda df: (done := plain(df), looked.append(done.count() if set(done.columns) == {"a", "b"} else 0))[0])
    star, path = [(1000, i) for i in range(1001, 1040)], [(0, 1), (1, 2), (2, 3)]
    later = [(3, 1020), (5000, 1039), (6000, 6001), (7, 7), (0, 2)]
    frame = lambda links: spark.createDataFrame(links, "a long, b long").coalesce(1)
    known = plain(c.components(frame(star + path)))
    looked.clear()
    got = {x["node"]: x["root"] for x in c.components(frame(later), known).collect()}
    assert max(looked) <= 2 * len(later)
    assert got == {**{i: 0 for i in [0, 1, 2, 3, 5000, *range(1000, 1040)]}, 6000: 6000, 6001: 6000}
