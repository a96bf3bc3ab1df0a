from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from graticule.llm import setsketch as s
from tests.llm.test_jaccard import near, shingles


def brute(given, words=4, percent=80):
    """Rows with set size, component and links, from all pairs."""
    sets = [shingles(t, words) for _, t in given]
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


def rows_of(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def pair(n, share, seed):
    both = round(2 * n * share / (1 + share))
    x = np.random.default_rng(seed).integers(0, 2**63, 2 * n - both).astype(np.uint64)
    return x[:n], x[n - both :]


def test_odd_rows(docs_of, odd_rows):
    assert rows_of(s.near_copies(docs_of(odd_rows))) == brute(odd_rows)


@pytest.mark.parametrize("chunk", [2000, 7])
def test_against_all_pairs(docs_of, prose, monkeypatch, chunk):
    """Chains of ever further copies, sets near the border, a hot group, shared passages, one text with many links."""
    given, k = [], 0
    for base in range(10):
        text = prose(base, 30 + 40 * base)
        for step in range(8):
            given.append((1000 - k, text))
            text = near(text, 100 * base + step, 0.02 * (step % 4 + 1))
            k += 1
    passage = prose(77, 60)
    given += [(2000 + i, prose(500 + i, 15 + i) + " " + passage) for i in range(40)]
    hot = prose(99, 120)
    given += [(3000 + i, near(hot, i, 0.01)) for i in range(60)] + [(4000 + i, near(hot, i, 0.05)) for i in range(40)]
    given += [(5000 + i, hot) for i in range(30)]
    random.Random(5).shuffle(given)
    monkeypatch.setattr(s, "CHUNK", chunk)
    monkeypatch.setattr(s, "HOT", 8)
    assert rows_of(s.near_copies(docs_of(given))) == brute(given)


def test_like_texts_that_do_not_link(docs_of, prose):
    """A family about 60 to 80 % alike: only some pairs link."""
    clauses = [prose(i, 12) for i in range(20)]
    r = random.Random(3)
    given = [(i, " ".join(clauses[c] for c in sorted(r.sample(range(20), 18)))) for i in range(80)]
    assert rows_of(s.near_copies(docs_of(given))) == brute(given)


def test_one_row_of_a_group_stays(docs_of, odd_rows):
    df = docs_of(odd_rows)
    got = s.drop_near(df)
    assert got.columns == df.columns
    blank = sum(1 for _, t in odd_rows if not shingles(t))
    assert got.count() == blank + len({c for (_, n, c) in brute(odd_rows) if n})


def test_empty(docs_of):
    assert s.near_copies(docs_of([])).collect() == []
    assert s.drop_near(docs_of([])).collect() == []


def test_merge_is_the_sketch_of_the_union():
    a, b = pair(500, 0.3, 1)
    assert (s.merge(s.sketch(a), s.sketch(b)) == s.sketch(np.union1d(a, b))).all()
    assert not s.sketch(a[:0]).any()


@pytest.mark.parametrize("n", [1, 30, 1000, 30_000])
def test_cardinality(n):
    found = [s.cardinality(s.sketch(np.random.default_rng(i).integers(0, 2**63, n).astype(np.uint64))) for i in range(10)]
    assert abs(np.mean(found) / n - 1) < 0.08


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8, 0.95])
def test_joint_estimate(share):
    errors = []
    for seed in range(40):
        a, b = pair(400, share, seed)
        n = np.array([400.0])
        got, possible = s.similarity(s.sketch(a)[None], s.sketch(b)[None], n, n, 80)
        errors.append(got[0] - share)
        assert possible[0] or share < 0.8
        assert not possible[0] or share > 0.5
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_sizes_narrow_the_estimate():
    x = np.random.default_rng(4).integers(0, 2**63, 400).astype(np.uint64)
    got, possible = s.similarity(s.sketch(x)[None], s.sketch(x[:300])[None], np.array([400.0]), np.array([300.0]), 80)
    assert abs(got[0] - 0.75) < 0.04 and not s.similarity(s.sketch(x)[None], s.sketch(x[:100])[None], np.array([400.0]), np.array([100.0]), 80)[1][0]


def test_bands_meet():
    """Of pairs at 80 %, all share a band; of those at 20 %, few do."""
    met = {share: sum(bool(np.intersect1d(*[s.band_keys(s.sketch(x)) for x in pair(200, share, seed)]).size) for seed in range(300)) for share in (0.2, 0.8)}
    assert met[0.8] == 300 and met[0.2] < 40


@pytest.mark.parametrize("n, share", [(1, 0.0), (7, 0.5), (200, 0.69), (200, 0.8), (3000, 0.8)])
def test_marks_differ_no_more_than_sets(n, share):
    for seed in range(20):
        a, b = pair(n, share, seed)
        differ = sum(bin((int(x) ^ int(y)) & (1 << 64) - 1).count("1") for x, y in zip(s.marks(a), s.marks(b)))
        assert differ <= len(set(a.tolist()) ^ set(b.tolist()))
    assert len(s.marks(a)) == s.MARKS


def test_a_family_that_does_not_link_makes_few_pairs(docs_of, prose, monkeypatch):
    """160 texts at about 70 %, each word run shared with others; all were paired with all before marks."""
    base = prose(7, 220).split()
    rng = random.Random(5)
    given = []
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(len(words)), 10):
            words[at] = f"other{rng.randrange(3)}"
        given.append((i, " ".join(words)))
    given += [(1000 + i, t) for i, t in given[:2]] + [(2000, " ".join(base))]
    made, write = [], s.materialize

    def counted(df, label):
        out = write(df, label)
        if label == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(s, "materialize", counted)
    assert rows_of(s.near_copies(docs_of(given))) == brute(given)
    assert sum(made[s.CENTRAL :]) < 400


@pytest.mark.parametrize("hot", [0, 3, 1024])
def test_few_pairs_and_many(docs_of, prose, monkeypatch, hot):
    """Pairs sent to the rows, dealt over copies of a row, and both in different rounds give the same."""
    monkeypatch.setattr(s, "HOT", hot or 1)
    if not hot:
        monkeypatch.setattr(s, "_with", lambda pairs, side, key, other, few, f=s._with: f(pairs, side, key, other, False))
    given = [(100 * base + i, near(prose(base, 60), i, 0.03 * (i % 4))) for base in range(4) for i in range(9)]
    assert rows_of(s.near_copies(docs_of(given))) == brute(given)
