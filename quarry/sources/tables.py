"""Scans and literal sources.

Scans are plain ``spark.read`` calls so Catalyst can prune columns and push
filters into the Parquet reader; nothing here materialises data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import importable

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Named table scan."""
    importable(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def load_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: load(spark, sf_dir, t) for t in TABLES}


def values(spark: SparkSession, rows, schema) -> DataFrame:
    """Inline literal table with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def seq(spark: SparkSession, n: int, name: str = "id") -> DataFrame:
    """S3: 0..n-1 row generator (distributed, no driver data)."""
    return spark.range(n).withColumnRenamed("id", name)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Directory listing as a table ``(path, length, modification_time)``.

    ``content`` is never selected, so the binaryFile reader skips reading
    file bodies (column pruning).
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "path",
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modification_time"),
        )
    )


def read_files(spark: SparkSession, path: str, glob: str = "*", as_text: bool = True) -> DataFrame:
    """One row per file with its content (``text`` or raw ``content``)."""
    if as_text:
        return (
            spark.read.option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .text(path, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text"))
        )
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "content")
    )


def from_local(spark: SparkSession, pdf, schema: T.StructType | str) -> DataFrame:
    """Local pandas frame -> DataFrame through Arrow, schema always given."""
    return spark.createDataFrame(pdf, schema=schema)
