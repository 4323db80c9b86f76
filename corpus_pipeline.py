"""From ``documents`` to token ids in four stages, each written as Parquet and read again as the next one's input.

Every stage works on all rows its predecessor kept. Columns beyond those it needs are carried through, whatever their
names. Null and empty texts: not toxic, in no group, no words for the mix, no tokens. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm import mixing, ngram_join, sentence_pieces, toxicity
from roadpulse.llm.common import landed, ready


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5, learnt from the labels of ``sf_dir``."""
    models = toxicity.train(docs, toxicity.labels_to_learn(ready(spark), sf_dir))
    into = "toxicity"
    while into in docs.columns:
        into += "_"
    return toxicity.score(docs, models, into=into).where(F.col(into) < 0.5).drop(into)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return ngram_join.representatives(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares of all words: a row for each copy that the mix takes."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each row, with digests of them and of the text they decode to."""
    return sentence_pieces.digests(docs, sentence_pieces.default_model(), keep_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_join", without_near_duplicates),
    ("mixing", mixed_sources),
    ("sentence_pieces", encoded),
]

#: Trained models and byte-pair merges are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
