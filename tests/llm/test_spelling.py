from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from graticule.llm import spelling as s

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """A change of exactly one letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(given, shortest=6, least=5, times=5):
    counts = Counter()
    for d, text in given:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    close = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w in words:
        n, best = min(((-words[x], x) for x in close[w]), default=(0, None))
        form[w] = best if -n >= times * words[w] else None

    def root(w):
        while form.get(w):
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(close[w]), words[form[w]] if form[w] else None) for w in words}


def changed(word, r, letters="abcdeéÿ"):
    at = r.randrange(len(word) + 1)
    return r.choice([word[:at] + r.choice(letters) + word[at:], word[:at] + word[at + 1 :], word[:at] + r.choice(letters) + word[at + 1 :]])


def texts(seed, letters="abc"):
    """Few letters, so that words have many near ones; chains of forms."""
    r = random.Random(seed)
    bag = []
    for _ in range(25):
        word, n = "".join(r.choices(letters, k=r.randint(5, 11))), 700
        while n >= 4:
            bag += [word] * n
            for _ in range(4):
                bag += [changed(word, r)] * r.randint(3, max(4, n // 4))
            word, n = changed(word, r), n // r.randint(4, 7)
    bag += ["Straße", "STRASSE", "straſe", "Ärger×÷ÿ", "日本語", "naïve-word"] * 12
    r.shuffle(bag)
    return [(i, r.choice([" ", "\n", "-1 "]).join(bag[i::50])) for i in range(50)]


def frame(spark, given, parts=3):
    df = spark.createDataFrame([(*g, "x", 1, "y") for g in given], "doc_id long, text string, word string, n int, root string")
    return df.repartition(parts) if given else df


@pytest.mark.parametrize("shard", [20_000, 25])
def test_against_all_pairs(spark, monkeypatch, shard):
    """Also with halves that fill many shards."""
    given = texts(1) + [(None, "Wordword " * 40), (None, None), (7, ""), (7, " \t"), (9, "zz" * 3000), (9, ("q" * 4000 + " ") * 6 + ("q" * 3999 + " ") * 40)]
    monkeypatch.setattr(s, "SHARD", shard)
    monkeypatch.setattr(s, "QUERIES", 2)
    assert {tuple(r) for r in s.variants(frame(spark, given)).collect()} == brute(given)


def test_one_half_shared_by_all(spark, monkeypatch):
    r = random.Random(3)
    given = [(i, " ".join(["aaaaaa" + "".join(r.choices("ab", k=6))] * r.randint(5, 60))) for i in range(150)]
    monkeypatch.setattr(s, "SHARD", 20)
    monkeypatch.setattr(s, "QUERIES", 1)
    assert {tuple(r) for r in s.variants(frame(spark, given)).collect()} == brute(given)


def test_ties_take_the_first_by_code_points(spark):
    given = [(1, "wordaa " * 5 + "wordab " * 30 + "wordac " * 30 + "wordaÿ " * 30)]
    got = {r["word"]: r["form"] for r in s.variants(frame(spark, given)).collect()}
    want = {w: f for w, f, *_ in brute(given)}
    assert got == want and got["wordaa"] == "wordab"


def test_suffix_array():
    r = random.Random(1)
    for _ in range(30):
        text = [r.randint(1, 3) for _ in range(r.randint(0, 60))] + [0]
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert s.suffix_array(np.array(text)).tolist() == want


def test_search_scheme():
    r = random.Random(2)
    words = sorted({"".join(r.choices("abcd", k=r.randint(4, 9))) for _ in range(400)})
    index = s.BidirectionalIndex(words)
    asked = words[::3] + [changed(w, r, "abxÿ") for w in words[::5]]
    asked = [w for w in asked if len(w) > 3]
    got = set()
    for rightward in (True, False):
        got |= {(asked[q], words[w]) for q, w in zip(*index.search(asked, rightward))}
    assert got == {(a, w) for a in asked for w in words if near(a, w)}


def test_intervals_stay_in_step():
    """Rows of both arrays belong to the same stretch after extensions to either end."""
    words = ["banana", "bandana", "cabana", "anagram"]
    index = s.BidirectionalIndex(words)
    text = "#" + "#".join(words) + "#"
    code = {c: int(np.searchsorted(index.letters, ord(c))) + 1 for c in set(text)}
    one = np.zeros(1, dtype=np.int64)
    states, stretch = s.States(one, one, one, one + len(text) + 1), ""
    for letter, right in (("a", True), ("n", True), ("b", False), ("a", False), ("a", True)):
        symbol = np.array([code[letter]])
        if right:
            states = index.extend(index.right, states.turned(), symbol).turned() if len(states) else states
            stretch += letter
        else:
            states = index.extend(index.left, states, symbol)
            stretch = letter + stretch
        at = [i for i in range(len(text)) if text.startswith(stretch, i)]
        assert (int(states.size[0]) if len(states) else 0) == len(at)
        if len(states):
            lo, hi = int(states.own[0]), int(states.own[0] + states.size[0])
            assert sorted(index.left.rows[lo:hi].tolist()) == at
            lo, hi = int(states.other[0]), int(states.other[0] + states.size[0])
            assert sorted(len(text) - r - len(stretch) for r in index.right.rows[lo:hi].tolist()) == at


def test_empty(spark):
    assert s.variants(frame(spark, [])).collect() == []
    assert s.variants(frame(spark, [(1, "short"), (2, None)])).collect() == []
    with pytest.raises(ValueError):
        s.variants(frame(spark, []), times=1)
