"""Bounded, documented samples of labelled rows, and the fold that is never learned from."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fold kept from training: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _learnable(labels: DataFrame, label: str, id_col: str) -> DataFrame:
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
    return rows.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))


def label_counts(labels: DataFrame, label: str, id_col: str = "doc_id") -> tuple[int, int]:
    """Rows with label 1 and rows with another label, outside the held-out fold."""
    row = _learnable(labels, label, id_col).agg(F.count_if(F.col("label") == 1).alias("one"), F.count_if(F.col("label") != 1).alias("other")).first()
    return row["one"], row["other"]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limits: dict[int, int], id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> DataFrame:
    """(doc_id, text, label) of at most ``limits[l]`` labelled rows of each label l outside the held-out fold.

    The rows are those with the smallest seeded hash of the id; only they are
    broadcast to the scan of the texts.  An id labelled twice takes the larger label.
    """
    rows = _learnable(labels, label, id_col)
    parts = [rows.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n) for v, n in limits.items()]
    picked = functools.reduce(DataFrame.union, parts).groupBy("doc_id").agg(F.max("label").alias("label"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label")
