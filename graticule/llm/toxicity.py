"""Toxicity by a chain of linear classifiers over words."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.llm.common import table

EDGES = ".,;:!?\"'()[]"  # stripped from words
SHAPES = 4  # features of a text's form, besides its words
FOLDS = 5
CAPITALS = re.compile("[A-Z]")


def words_and_shape(text: str | None) -> tuple[set[str], list[float]]:
    """Distinct lower-case words and their beginnings (4 letters and ``~``, so that inflected
    and compound words are known by their stem), and: log length, shares of distinct words,
    capitals and symbols."""
    text = text or ""
    words = text.lower().split()
    distinct = {w.strip(EDGES) for w in set(words)}
    distinct.discard("")
    distinct |= {w[:4] + "~" for w in distinct}
    n = max(1, len(words))
    chars = max(1, len(text))
    symbols = sum(map(text.count, "#*$%&|<>!"))
    capitals = len(CAPITALS.findall(text))
    return distinct, [float(np.log1p(len(words))) / 10, len(distinct) / n, min(1.0, 4 * capitals / chars), min(1.0, 20 * symbols / chars)]


@dataclass
class Linear:
    """One link of the chain: weights of words, of the shape and of the earlier links' log odds."""

    words: dict[str, float]
    dense: list[float]
    bias: float
    known: frozenset = field(default_factory=frozenset)

    def log_odds(self, distinct: set[str], dense: Sequence[float]) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.dense, dense))
        return float(min(30.0, max(-30.0, z + sum(map(self.words.__getitem__, distinct & self.known)))))


@dataclass
class Chain:
    names: list[str]
    links: list[Linear]
    thresholds: list[float]

    def probabilities(self, text: str | None) -> list[float]:
        distinct, dense = words_and_shape(text)
        for link in self.links:
            dense = [*dense, link.log_odds(distinct, dense)]
        return [1 / (1 + float(np.exp(-z))) for z in dense[SHAPES:]]


class Words:
    """The words of a sample of texts as numbers, only those that at least ``least`` texts have, and the texts' shapes.

    The texts are read twice, so that the driver holds numbers and never all words of all texts.
    """

    def __init__(self, texts: Sequence[str | None], least: int = 4):
        counts = Counter()
        shapes = []
        for text in texts:
            words, shape = words_and_shape(text)
            counts.update(words)
            shapes.append(shape)
        self.dense = np.array(shapes).reshape(-1, SHAPES)
        self.names = sorted(w for w, n in counts.items() if n >= least)
        del counts
        place = {w: i for i, w in enumerate(self.names)}
        found = [np.array([place[w] for w in words_and_shape(t)[0] if w in place], dtype=np.int64) for t in texts]
        self.row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        self.word = np.concatenate([np.zeros(0, dtype=np.int64), *found])

    def indicative(self, among: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
        """The words whose share among the given rows differs most between the classes, in standard errors."""
        n1, n0 = y[among].sum(), (~y[among]).sum()
        given = np.zeros(len(y), dtype=bool)
        given[among] = True
        use = given[self.row]
        a = np.bincount(self.word[use & y[self.row]], minlength=len(self.names))
        b = np.bincount(self.word[use & ~y[self.row]], minlength=len(self.names))
        p = (a + b) / (n1 + n0)
        z = np.abs(a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-9)
        best = np.argsort(-z, kind="stable")[:most]
        return best[z[best] > 3]

    def matrix(self, chosen: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Rows by the chosen words (0 or 1), the dense features and a constant."""
        place = np.full(len(self.names) + 1, -1)
        place[chosen] = np.arange(len(chosen))
        at = place[self.word]
        x = np.zeros((len(dense), len(chosen) + dense.shape[1] + 1))
        x[self.row[at >= 0], at[at >= 0]] = 1.0
        x[:, len(chosen) : -1] = dense
        x[:, -1] = 1.0
        return x


def fit_linear(words: Words, dense: np.ndarray, y: np.ndarray, among: np.ndarray, features: int = 300, ridge: float = 0.5, steps: int = 12):
    """Ridge logistic regression by Newton steps, fitted to the rows ``among``; classes weigh alike.

    Returns the link and the log odds it gives to every row.
    """
    t = y[among]
    if not len(t) or t.min() == t.max():
        sure = 30.0 if len(t) and t.all() else -30.0
        return Linear({}, [0.0] * dense.shape[1], sure), np.full(len(y), sure)
    chosen = words.indicative(among, y, features)
    every = words.matrix(chosen, dense)
    x = every[among]
    weight = np.where(t, 0.5 / t.mean(), 0.5 / (1 - t.mean()))
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = weight * np.maximum(p * (1 - p), 1e-4)
        change = np.linalg.solve((x.T * curve) @ x + np.diag(penalty), x.T @ (weight * (t - p)) - penalty * beta)
        beta += change
        if np.abs(change).max() < 1e-2:
            break
    weights = {words.names[i]: float(b) for i, b in zip(chosen, beta)}
    link = Linear(weights, [float(b) for b in beta[len(chosen) : -1]], float(beta[-1]), frozenset(weights))
    return link, np.clip(every @ beta, -30, 30)


def _best_threshold(p: np.ndarray, y: np.ndarray, share: float) -> float:
    """Where out-of-fold F1 is best at the true share of positives; the middle of the best gap."""
    if not len(y) or y.min() == y.max():
        return 0.5
    w = np.where(y, share / y.mean(), (1 - share) / (1 - y.mean()))
    order = np.argsort(-p, kind="stable")
    hit, miss = np.cumsum(np.where(y[order], w[order], 0)), np.cumsum(np.where(y[order], 0, w[order]))
    f1 = 2 * hit / (hit + miss + (w * y).sum())
    f1[:-1][np.diff(p[order]) == 0] = -1  # equal scores cannot be parted
    best = int(np.argmax(f1))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def fit_chain(rows: list[tuple[int, str | None, list[int]]], names: Sequence[str], shares: Sequence[float] | None = None) -> Chain:
    """Fit the links in order: each is given the log odds that the earlier ones predict out of fold."""
    words, everyone = Words([t for _, t, _ in rows]), np.arange(len(rows))
    dense = words.dense
    fold = np.array([zlib.crc32(str(d).encode()) % FOLDS for d, _, _ in rows])
    labels = np.array([c for _, _, c in rows], dtype=bool).reshape(-1, len(names))
    links, thresholds = [], []
    for k, _ in enumerate(names):
        y = labels[:, k]
        unseen = np.zeros(len(rows))
        for f in range(FOLDS):
            _, odds = fit_linear(words, dense, y, np.flatnonzero(fold != f))
            unseen[fold == f] = odds[fold == f]
        links.append(fit_linear(words, dense, y, everyone)[0])
        share = shares[k] if shares else (float(y.mean()) if len(y) else 0.0)
        thresholds.append(_best_threshold(1 / (1 + np.exp(-unseen)), y, share))
        dense = np.column_stack([dense, unseen])
    return Chain(list(names), links, thresholds)


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], doc_id: str, text: str, per_class: int):
    """Up to per_class positive and as many negative rows per category, by hash of the id, and the shares in all labels.

    This bounded sample (at most 2 * per_class rows per category) is all that the
    driver sees. Ids with several label rows count as positive if one of them is; of an id with several texts the
    smallest counts; rows without an id or with a null label are left out of the fit.
    """
    named = labels.select(F.col(doc_id).cast("long").alias("id"), *[c.cast("int").alias(f"c{i}") for i, c in enumerate(categories.values())])
    given = [f"c{i}" for i in range(len(categories))]
    named = named.dropna().groupBy("id").agg(*[F.max(c).alias(c) for c in given])
    shares = named.agg(*[F.avg(c).alias(c) for c in given]).first()
    picked = None
    for c in given:
        for value in (0, 1):
            part = named.where(F.col(c) == value).orderBy(F.xxhash64("id"), "id").limit(per_class)
            picked = part if picked is None else picked.unionByName(part)
    picked = picked.distinct()
    found = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id")
    # one row per id, however often it is repeated
    found = found.groupBy("id", *given).agg(F.min("text").alias("text"))
    rows = sorted(((r["id"], r["text"], [r[c] for c in given]) for r in found.collect()), key=lambda r: (r[0], r[1] or ""))
    return rows, [float(s or 0) for s in shares]


def scorer(chain: Chain) -> Callable[[Column], Column]:
    """A column function: text to a struct of one probability per category."""
    kept = chain

    @F.pandas_udf(", ".join(f"`{n}` double" for n in chain.names))
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([kept.probabilities(t) for t in texts], columns=kept.names, dtype=float)

    return score


# Fixed order of the chain: a poor text first, its odds then help to judge toxicity.
CATEGORIES = {"low_quality": lambda labels: labels["quality"] == 0, "toxic": lambda labels: labels["toxic"] == 1}


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", per_class: int = 1500, categories=None) -> Chain:
    chosen = {n: c(labels) for n, c in (categories or CATEGORIES).items()}
    rows, shares = labelled_sample(docs, labels, chosen, doc_id, text, per_class)
    return fit_chain(rows, list(chosen), shares)


def toxicity(docs: DataFrame, chain: Chain, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, the chain's probability per category, rejected.

    A row is rejected when the last category's probability reaches its threshold.
    Whole texts are read, one at a time, against a bounded table of word weights.
    A null text counts as empty and a null doc_id stays null; repeated rows are
    scored alike; with no labels at all every probability is 0 and nothing is
    rejected; an empty table gives no rows; other columns are not read.
    """
    scored = docs.select(F.col(doc_id).alias("doc_id"), scorer(chain)(F.col(text)).alias("p"))
    return scored.select("doc_id", *[F.col(f"p.`{n}`").alias(f"p_{n}") for n in chain.names], (F.col("p")[chain.names[-1]] >= chain.thresholds[-1]).alias("rejected"))


def drop_toxic(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    return docs.where(scorer(chain)(docs[text])[chain.names[-1]] < chain.thresholds[-1])


def query(spark, sf_dir):
    """All documents scored by a chain fitted to the labels."""
    docs = table(spark, sf_dir, "documents")
    return toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
