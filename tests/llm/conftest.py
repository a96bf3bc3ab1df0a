from __future__ import annotations

import random

import pytest

from graticule.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside, and names of their results
CLASHES = ("_tag", "h", "n", "cls", "tokens", "kept", "sha256", "root", "rate", "p0", "spans", "shard", "_row", "ids")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text) or full rows as documents, with extra columns of clashing names."""

    def make(rows, parts: int = 3):
        full = [(*r, "en", "s", None) if len(r) == 2 else r for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)
        for name in CLASHES:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """Words at random: prose(seed, number of words)."""
    syllables = "an er th on re in ed nd ha at en es of to it is ou ti al st".split()

    def make(seed: int, words: int) -> str:
        r = random.Random(seed)
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls, empty, blank and very long texts, repeated rows, ties, missing ids and other scripts."""
    long_text = prose(1, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, None), (6, long_text), (7, long_text + " end"),
        (8, prose(2, 80)), (9, prose(2, 80).upper()), (10, "日本語 テキスト   x\u001cy é ​ " * 8), (11, "a" * 5000), (12, prose(3, 4)), (13, "\n".join([prose(4, 30)] * 5)),
        (14, "<|endoftext|> <|turn|> &amp; &lt;| it's 'S 12.5"), (15, prose(2, 80)),
    ]
