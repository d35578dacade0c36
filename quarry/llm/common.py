"""Helpers shared by the operators: sizes from the planner, Arrow plumbing, scratch tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import scratch_path

MB = 1 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns the text operators read, as ``doc_id`` long and ``text`` string."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = MB) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 16
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]
