"""Mixing sources to target weights with soft memberships."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graticule.llm.common import row_tag, settled, table
from graticule.llm.toxicity import SHAPES, Linear, Words, fit_linear, labelled_sample, words_and_shape
from graticule.session import materialize


@dataclass
class Domains:
    """One linear classifier per domain and the domains' shares among the labels."""

    names: list[str]
    links: list[Linear]
    shares: list[float]

    def posteriors(self, text: str | None) -> list[float]:
        distinct, dense = words_and_shape(text)
        odds = [link.log_odds(distinct, dense) for link in self.links]
        z = np.array(odds) + np.log(np.maximum(self.shares, 1e-9))
        p = np.exp(z - z.max())
        return (p / p.sum()).tolist()


def train_domains(docs: DataFrame, labels: DataFrame, domains: dict[str, Column], doc_id: str = "doc_id", text: str = "text", per_class: int = 1200) -> Domains:
    """Fit each domain against the others on a bounded sample of labelled rows (2 * per_class per domain at most)."""
    rows, shares = labelled_sample(docs, labels, domains, doc_id, text, per_class)
    member = np.array([c for _, _, c in rows], dtype=bool).reshape(-1, len(domains))
    words, every = Words([t for _, t, _ in rows]), np.arange(len(rows))
    links = [fit_linear(words, words.dense, member[:, k], every)[0] for k in range(len(domains))]
    if not sum(shares):
        links, shares = [Linear({}, [0.0] * SHAPES, 0.0) for _ in domains], [1.0] * len(domains)
    return Domains(list(domains), links, shares)


def memberships(model: Domains) -> Callable[[Column], Column]:
    """A column function: text to a struct of tokens (words) and one posterior per domain."""
    fitted = model

    @F.pandas_udf("tokens long, " + ", ".join(f"p{k} double" for k in range(len(model.names))))
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [f"p{k}" for k in range(len(fitted.names))]
        for texts in batches:
            made = pd.DataFrame([fitted.posteriors(t) for t in texts], columns=names, dtype=float)
            made.insert(0, "tokens", [len((t or "").encode().split()) for t in texts])
            yield made

    return of


def rate(steps: Sequence[Sequence[float]], posteriors: Sequence[Column]) -> Column:
    """A row's rate after the given steps: each takes the step's share of its domains, and never goes below 0."""
    if not steps:
        return F.lit(1.0)
    taken = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])

    def move(now: Column, step: Column) -> Column:
        change = F.lit(0.0)
        for k, p in enumerate(posteriors):
            change = change + p * F.element_at(step, k + 1)
        return F.greatest(F.lit(0.0), now - change)

    return F.aggregate(taken, F.lit(1.0), move)


def fit_rates(soft: DataFrame, weights: Sequence[float], rounds: int = 40, close: float = 1e-6) -> list[list[float]]:
    """Projected-gradient least squares for rates whose expected domain totals meet the targets.

    ``soft`` has tokens and p0, p1, ... per row. With the targets ``weights`` (made to sum
    to 1) times all tokens, it minimises the squared distance of the totals from the targets,
    measured by the inverse of the totals' Gram matrix, over rates of 0 or more. The gradient
    in the token-weighted norm changes a row's rate by its posteriors times one number per
    domain, so a round is one pass of sums and the list of these numbers is the whole state:
    nothing is kept per row, and a lost executor costs one pass.
    """
    names = [c for c in soft.columns if c.startswith("p")]
    ps = [F.col(c) for c in names]
    t = F.col("tokens").cast("double")
    pairs = [(i, j) for i in range(len(ps)) for j in range(i, len(ps))]
    sums = soft.agg(F.sum(t).alias("all"), *[F.sum(t * ps[i] * ps[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    total = float(sums["all"] or 0.0)
    if not total:
        return []
    gram = np.zeros((len(ps), len(ps)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = sums[f"g{i}_{j}"]
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    targets = total * np.asarray(weights, dtype=float) / sum(weights)
    steps: list[list[float]] = []
    for _ in range(rounds):
        now = rate(steps, ps)
        row = soft.agg(*[F.sum(t * now * p).alias(f"s_{n}") for p, n in zip(ps, names)]).first()
        gap = np.array([row[f"s_{n}"] for n in names]) - targets
        if np.abs(gap).max() <= close * total:
            break
        steps.append((inverse @ gap).tolist())
    return steps


def copies(rates: Column, key: Column, seed: int = 17) -> Column:
    """How often a row is taken: the whole part of its rate, and once more with the rest as its chance (by the key, a hash)."""
    chance = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rates) + F.when(chance < rates - F.floor(rates), 1).otherwise(0)).cast("int")


def chance_key(doc_id: Column, text: Column, tag: Column) -> Column:
    """What a row's chance hangs on: id and text, so that it holds wherever the row is stored; without an id, its place."""
    return F.when(doc_id.isNotNull(), F.xxhash64(doc_id, text)).otherwise(tag)


def mixture(docs: DataFrame, model: Domains, weights: Sequence[float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, tokens, a posterior per domain, rate and copies (how often it is taken).

    Tokens are words parted by ASCII white space. A null or empty text has no tokens and
    its posteriors come from the priors; rows with a null doc_id or with one doc_id and
    different texts are drawn one by one; repeated rows get the same rate and copies; without labels all domains are alike; a domain that no text
    belongs to cannot meet its target and leaves the others as near as possible; an empty
    table gives no rows; other columns are not read.
    """
    docs = settled(docs)
    key = chance_key(docs[doc_id], docs[text], row_tag(docs)).alias("_key")
    scored = docs.select(F.col(doc_id).alias("doc_id"), key, memberships(model)(F.col(text)).alias("m")).select("doc_id", "_key", "m.*")
    soft = materialize(scored, "memberships")
    steps = fit_rates(soft.drop("doc_id", "_key"), weights)
    ps = [F.col(f"p{k}") for k in range(len(model.names))]
    rated = soft.withColumn("rate", rate(steps, ps))
    return rated.select("doc_id", "tokens", *[p.alias(f"p_{n}") for p, n in zip(ps, model.names)], "rate", copies(F.col("rate"), F.col("_key")).alias("copies"))


def mixed(docs: DataFrame, model: Domains, weights: Sequence[float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows as often as their rates say, with all their columns.

    The classifiers score each row once: the rows are written with their memberships, and
    rates, copies and the choice are columns of that table.
    """
    docs = settled(docs)
    key = chance_key(docs[doc_id], docs[text], row_tag(docs)).alias("_key")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    soft = materialize(docs.select(row, key, memberships(model)(docs[text]).alias("m")).select("_row", "_key", "m.*"), "memberships")
    steps = fit_rates(soft.drop("_row", "_key"), weights)
    rates = rate(steps, [F.col(f"p{k}") for k in range(len(model.names))])
    taken = soft.select("_row", copies(rates, F.col("_key")).alias("_n")).where("_n > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).select("_row.*")


def quality_domains(labels: DataFrame) -> dict[str, Column]:
    return {"good": labels["quality"] == 1, "poor": labels["quality"] == 0}


# Target shares of all tokens.
WEIGHTS = {"good": 0.95, "poor": 0.05}


def query(spark, sf_dir):
    """All documents with the rates that bring good and poor text to their target shares."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    domains = quality_domains(labels)
    return mixture(docs, train_domains(docs, labels, domains), [WEIGHTS[d] for d in domains])
