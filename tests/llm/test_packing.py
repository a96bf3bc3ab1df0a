from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from graticule.llm.packing import difference, fill, pack
from graticule.llm.word_ids import WordIds, vocabulary_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path(None))


def test_word_ids_equal_the_tokenizers(tokenizer, odd_rows, prose):
    ids = WordIds(vocabulary_path(None))
    ids.LIMIT = 50  # so that the tables are emptied now and then
    texts = [t for _, t in odd_rows if t] + [prose(i, 50).title() + ". Ünï l'été d'or ﬁ Σας İx" for i in range(20)]
    for t in texts:
        assert ids(t.encode()).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def check(rows, given, tokenizer, capacity):
    want = Counter()
    for d, t in given:
        want[d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4").tobytes()] += 1
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for (d, total), parts in pieces.items():
        expected = sorted((k[1], n) for k, n in want.items() if k[0] == d and len(k[1]) == 4 * total)
        starts = Counter(s for s, _ in parts)
        assert sum(len(p) for _, p in parts) == sum(len(e) * n for e, n in expected)
        if len(expected) == 1:
            text, n = expected[0]
            assert set(starts.values()) == {n} and b"".join(p for _, p in sorted(set(parts))) == text
    return 1 - sum(r["length"] for r in rows) / max(1, capacity * len(sequences))


def test_odd_rows(docs_of, odd_rows, tokenizer):
    check(pack(docs_of(odd_rows)).collect(), odd_rows, tokenizer, 2048)


def test_little_padding(docs_of, prose, tokenizer):
    given = [(i, prose(i, 20 + i * 7 % 900)) for i in range(400)]
    assert check(pack(docs_of(given, 1)).collect(), given, tokenizer, 2048) < 0.04


def test_empty(docs_of):
    assert pack(docs_of([])).collect() == []


def test_differencing():
    assert sorted(sum((8, 7, 6, 5, 4)[i] for i in w) for w in difference([8, 7, 6, 5, 4], 2)) == [14, 16]
    r = random.Random(3)
    for _ in range(30):
        sizes = [r.randint(1, 100) for _ in range(r.randint(1, 60))]
        dealt = fill(sizes, 100, 8)
        for i, size in enumerate(sizes):
            cuts = sorted((a, z) for w in dealt for k, a, z in w if k == i)
            assert cuts[0][0] == 0 and cuts[-1][1] == size and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:]))
        assert all(0 < sum(z - a for _, a, z in w) <= 100 for w in dealt)
