"""From raw documents to packed training sequences; every stage is one operator of ``graticule.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graticule.llm import packing
from graticule.llm.common import table
from graticule.llm.exact import drop_copies
from graticule.llm.jaccard import drop_near_copies
from graticule.llm.mixing import WEIGHTS, mixed, quality_domains, train_domains
from graticule.llm.toxicity import drop_toxic, train
from graticule.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word 5-grams with a similarity of 0.75 or more."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as brings good and poor text to their target shares of all tokens."""
    labels = table(spark, sf_dir, "labels")
    domains = quality_domains(labels)
    return mixed(docs, train_domains(docs, labels, domains), [WEIGHTS[d] for d in domains])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.digest(packing.pack(docs))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

# The first stage is a fitted classifier, so SQL cannot give the rows; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
