"""Corpus pipeline: stages applied one after the other to ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; each result is written as Parquet and read again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import jaccard, mixing, packing, pii, toxicity
from quarry.llm.common import written
from quarry.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores 0.5 or more go; the model is learned from these documents' labels."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    return jaccard.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind in brackets; ``n_chars`` follows the text."""
    return pii.with_masked_length(docs, "text", "n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics meet their target weights."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, placed in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # the classifier, the disguises of personal data and the tokenizer have no SQL form; tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every stage's result is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
