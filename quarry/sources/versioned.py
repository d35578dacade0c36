"""Tables that are changed by rewriting only what a change touches (S11, M19, ST4, ST5).

A table is dealt to buckets by a hash of its key columns.  A version is a
manifest: one row per bucket with the folder that holds its rows now.  A change
reads the buckets that its rows fall into, writes these to a folder of the new
version and a manifest in which all other buckets keep the folders they had.

    root/v<version>/__kb=<bucket>/   rows of the buckets changed in a version
    root/_manifest/v<version>/       (bucket, path, buckets, keys, schema): bucket count and keys are the table's, not
                                     the session's; a row of bucket -1 holds them where there are no buckets

Versions are numbered by the caller (a streaming epoch, or one more than the
last).  Writing a version again writes the same folder from the same version
before it, so a repeated micro-batch changes nothing.  Readers of older
versions are not disturbed until ``expire`` removes folders that none of the
newest versions names.

A manifest has as many rows as buckets; it is the only thing the driver holds.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.sources.sinks import merge_update

MANIFEST = "bucket int, path string, buckets int, keys array<string>, schema string"
TABLE = -1  # the manifest row of the table itself


def _bucket(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, root: str, version: int) -> list:
    """The rows of a version's manifest."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifest/v{version}").collect()


def _write(spark: SparkSession, root: str, version: int, rows: DataFrame, touched: list[int], kept: list, keys: list[str], buckets: int) -> None:
    """Write the rows of the touched buckets and the manifest that names them beside the kept ones."""
    path = f"{root}/v{version}"
    rows.withColumn("__kb", _bucket(keys, buckets)).repartition("__kb").write.mode("overwrite").partitionBy("__kb").parquet(path)
    named = [(TABLE, path, buckets, keys, rows.schema.json())]
    named += [(b, path, buckets, keys, None) for b in touched] + [(r["bucket"], r["path"], buckets, keys, None) for r in kept if r["bucket"] != TABLE]
    spark.createDataFrame(named, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/_manifest/v{version}")


def create(df: DataFrame, root: str, keys: list[str], buckets: int = 64, version: int = 0) -> None:
    """Write ``df`` as the first version of a table."""
    held = [r["b"] for r in df.select(_bucket(keys, buckets).alias("b")).distinct().collect()]  # at most as many rows as buckets
    _write(df.sparkSession, root, version, df, held, [], keys, buckets)


def read(spark: SparkSession, root: str, version: int, only: set[int] | None = None) -> DataFrame:
    """A version of the table; ``only`` reads no more than those buckets."""
    rows = manifest(spark, root, version)
    schema = StructType.fromJson(json.loads(next(r["schema"] for r in rows if r["bucket"] == TABLE)))
    paths: dict[str, list[int]] = {}
    for r in rows:
        if r["bucket"] != TABLE and (only is None or r["bucket"] in only):
            paths.setdefault(r["path"], []).append(r["bucket"])
    # folders of a bucket that lost all its rows are not there
    found = [_existing(spark, path, buckets) for path, buckets in paths.items()]
    parts = [spark.read.schema(schema).parquet(*folders) for folders in found if folders]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def _existing(spark: SparkSession, path: str, buckets: list[int]) -> list[str]:
    fs, folder = _files(spark, path)
    held = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
    return [f"{path}/__kb={b}" for b in sorted(buckets) if f"__kb={b}" in held]


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def merge(spark: SparkSession, root: str, changes: DataFrame, version: int, cols: list[str] | None = None) -> set[int]:
    """Write ``version`` from the version before it and ``changes``; the buckets rewritten.

    With ``cols``: MERGE, WHEN MATCHED THEN UPDATE SET cols (changes must be
    unique on the keys; keys the table does not have change nothing).
    Without: the changes replace the rows of their keys and are added where
    there are none (a null key equals a null key).  A change of no rows keeps
    every bucket.
    """
    before = manifest(spark, root, version - 1)
    buckets, keys = before[0]["buckets"], before[0]["keys"]
    touched = {r["b"] for r in changes.select(_bucket(keys, buckets).alias("b")).distinct().collect()}  # at most as many rows as buckets
    if cols is not None:
        touched &= {r["bucket"] for r in before}
    old = read(spark, root, version - 1, touched)
    if cols is not None:
        rows = merge_update(old, changes, keys, cols)
    else:
        same = reduce(lambda a, b: a & b, [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys])
        rows = old.alias("o").join(changes.select(*keys).distinct().alias("n"), same, "left_anti").unionByName(changes)
    _write(spark, root, version, rows, sorted(touched), [r for r in before if r["bucket"] not in touched], keys, buckets)
    return touched


def expire(spark: SparkSession, root: str, newest: int, keep: int = 2) -> list[str]:
    """Remove the manifests before the ``keep`` newest versions and the data folders that none of those names; their paths."""
    first = newest - keep + 1
    named = {tuple(r["path"].split("/")[-1:]) + (f"__kb={r['bucket']}",) for v in range(max(0, first), newest + 1) for r in manifest(spark, root, v) if r["bucket"] != TABLE}
    gone = []
    fs, top = _files(spark, root)
    for folder in fs.listStatus(top):
        name = folder.getPath().getName()
        if not folder.isDirectory() or not name.startswith("v") or int(name[1:]) >= newest:
            continue
        for bucket in fs.listStatus(folder.getPath()):
            inside = bucket.getPath().getName()
            if bucket.isDirectory() and (name, inside) not in named:
                fs.delete(bucket.getPath(), True)
                gone.append(f"{name}/{inside}")
    fs, folders = _files(spark, f"{root}/_manifest")
    for folder in fs.listStatus(folders):
        if int(folder.getPath().getName()[1:]) < first:
            fs.delete(folder.getPath(), True)
    return sorted(gone)
