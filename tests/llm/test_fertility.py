from __future__ import annotations

import re
from collections import Counter

import numpy as np

from graticule.llm import fertility as fert


def plain(t):
    t = t or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_counts(odd_rows, prose):
    texts = [t for _, t in odd_rows] + [prose(1, 7), prose(1, 9), "a " * 9, "a b " * 40, (prose(5, 20) + " ") * 3 + prose(6, 30)]
    for t in texts:
        assert fert.counts((t or "").encode()) == plain(t)


def test_verdict(docs_of, odd_rows, prose):
    given = list(odd_rows) + [(100 + i, prose(i, 60 + i % 20)) for i in range(120)]
    given += [(500, "日本語の文章です " * 1 + " ".join(chr(0x4E00 + 37 * i) * 3 for i in range(70))), (501, " ".join(f"{i:x}zq9" for i in range(90)))]
    got = fert.fertility(docs_of(given)).collect()
    assert len(got) == len(given)
    rows = {r["doc_id"]: r for r in got}
    for d, t in given:
        if d not in (None, 5):
            c = plain(t)
            assert tuple(rows[d][n] for n in fert.COUNTS) == c
            assert rows[d]["base_failed"] == (c[0] < 20 or 100 * c[4] > 30 * c[0])
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert all(rows[100 + i]["kept"] for i in range(120))
    assert not rows[500]["kept"] and rows[500]["byte_share"] > 0.5


def test_measures():
    n, per, share, entropy = fert.token_measures(np.array([5, 5, 9, 7]), 12, np.array([False] * 9 + [True]))
    assert (n, per, share, entropy) == (4, 3.0, 0.25, 1.5)


def test_empty(docs_of):
    assert fert.fertility(docs_of([])).collect() == []


def test_bands_bite(docs_of, prose):
    """Texts of few words over and over, or with signs between, fall; nearly all others stay, also in small classes."""
    given = [(i, prose(i, 60 + i % 300)) for i in range(400)]
    given += [(500 + i, prose(600 + i, 60 + 40 * i).replace(" ", "### ")) for i in range(8)]
    r = np.random.default_rng(3)
    for i in range(8):
        few = prose(700 + i, 12).split()
        given.append((600 + i, " ".join(r.choice(few, 100 + 20 * i))))
    given.append((700, prose(800, 6000)))  # alone in its class
    rows = {r["doc_id"]: r for r in fert.fertility(docs_of(given)).collect()}
    assert not any(rows[d]["base_failed"] for d in rows)
    assert not any(rows[d]["kept"] for d in rows if 500 <= d < 700)
    assert sum(rows[i]["kept"] for i in range(400)) >= 390
