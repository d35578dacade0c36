"""Sinks and table maintenance.

Parquet has no MERGE, so updates write a *new version directory* and never
overwrite the path being read; a manifest row records what was written.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MODES = {"replace": "overwrite", "skip": "ignore", "error": "errorifexists"}


def save(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> None:
    """Write a table (overwrite by default)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def append_by_name(df: DataFrame, target: DataFrame | list[str], path: str) -> None:
    """Append with columns matched by *name*, not position."""
    cols = target.columns if isinstance(target, DataFrame) else list(target)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"append_by_name: source lacks columns {missing}")
    df.select(*cols).write.mode("append").parquet(path)


def ctas(df: DataFrame, path: str, if_exists: str = "replace") -> None:
    """CREATE [OR REPLACE | IF NOT EXISTS] TABLE AS SELECT."""
    df.write.mode(_MODES[if_exists]).parquet(path)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Concatenate frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def merge_update(target: DataFrame, updates: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``MERGE ... WHEN MATCHED THEN UPDATE SET cols`` as a DataFrame.

    Updates must be unique on ``keys`` (checked lazily: a duplicate raises at
    run time through ``raise_error``).  Returns the new version of the
    target; the caller writes it to a new version folder.
    """
    # One aggregation both de-duplicates-checks and shapes the update side:
    # a key with two update rows fails the job instead of fanning out.
    u = (
        updates.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(f"__new_{c}") for c in cols])
        .withColumn(
            "__hit",
            F.when(F.col("__n") > 1, F.raise_error(F.lit("merge_update: updates not unique on keys")))
            .otherwise(F.lit(True)),
        )
        .drop("__n")
    )
    joined = target.join(u, on=keys, how="left")
    # The marker column makes a NULL update value still count as matched.
    matched = F.col("__hit").isNotNull()
    return joined.select(
        *[
            (F.when(matched, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c))
            for c in target.columns
        ]
    )


def materialize(df: DataFrame, path: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Keep a result for reuse.

    With a path (a shared folder, e.g. under ``spark.checkpoint.dir``) the
    result is written and read back, which also cuts lineage and survives
    executor loss; without one it is persisted memory-and-disk.
    """
    if path is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    df.write.mode("overwrite").parquet(path)
    return (spark or df.sparkSession).read.parquet(path)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_fk(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]] | dict) -> DataFrame:
    """Child rows whose foreign key has no parent (``left_anti``)."""
    pairs = list(on.items()) if isinstance(on, dict) else list(on)
    cond = reduce(lambda a, b: a & b, [child[c] == parent[p] for c, p in pairs])
    return child.join(parent, cond, "left_anti")


def snapshot(df: DataFrame, root: str, name: str, version: str, sources: list[str] | None = None) -> DataFrame:
    """Immutable versioned dataset ``root/name/version`` + manifest.

    ``errorifexists`` makes a version immutable.  The manifest is a one-row
    JSON table next to the data: row count, columns, sources.
    """
    path = f"{root.rstrip('/')}/{name}/{version}"
    df.write.mode("errorifexists").parquet(f"{path}/data")
    spark = df.sparkSession
    out = spark.read.parquet(f"{path}/data")
    n = out.count()
    manifest = spark.createDataFrame(
        [(name, version, n, json.dumps(out.columns), json.dumps(sources or []))],
        "name string, version string, rows long, columns string, sources string",
    )
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/manifest")
    return out


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Column comments kept as schema metadata."""
    for c, text in comments.items():
        df = df.withMetadata(c, {"comment": text})
    return df
