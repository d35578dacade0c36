"""Vectors in Arrow and numpy, and the query-by-part search frame that operators 4 and 9 share.

Candidates are dealt to parts of bounded size; the queries, packed into
blocks, are sent to every part (a stated query set against all rows, in
blocks).  A task holds one part and streams the query blocks past it, so its
memory does not grow with either side; it returns at most k rows per query,
and a window over (query, score) merges the parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 512


def usable(vector: str) -> Column:
    """True for vectors that are not null, not empty and hold only finite numbers."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(~bad, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a float64 matrix; a column without rows has no columns either."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def packed(ids: np.ndarray, rows: np.ndarray) -> bytes:
    return ids.astype("<i8").tobytes() + np.ascontiguousarray(rows, "<f8").tobytes()


def unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(blob, "<i8", n)
    return ids, np.frombuffer(blob, "<f8", offset=8 * n).reshape(n, -1)


def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> DataFrame:
    """(dim, n, blob) rows of at most ``size`` queries each, from (id, vec)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, rows = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([packed(np.array(ids), np.array(rows))], pa.binary())], ["dim", "n", "blob"])

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vec")):
                row = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                held.setdefault(len(row), []).append((i, row))
                if len(held[len(row)]) >= size:
                    yield block(len(row))
        for dim in list(held):
            yield block(dim)

    return queries.mapInArrow(pack, "dim int, n int, blob binary")


Search = Callable[[np.ndarray, np.ndarray], Callable[[np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]]]


def search_parts(candidates: DataFrame, part: Column, queries: DataFrame, open_part: Search, score_type: str) -> DataFrame:
    """(query_id, vec_id, score) rows: what ``open_part`` finds in each part for each query block.

    ``candidates`` is (id, vec); ``part`` numbers its bounded parts.
    ``open_part(ids, rows)`` prepares a part and returns a function of a query
    block that yields (query id, candidate ids, scores).
    Vectors of different lengths never meet.
    """
    cand = candidates.select(part.alias("part"), F.size("vec").alias("dim"), F.lit(0).alias("kind"), "id", "vec", F.lit(None).cast("int").alias("n"), F.lit(None).cast("binary").alias("blob"))
    parts = cand.select("part", "dim").distinct()
    blocks = query_blocks(queries)
    # the meeting of parts and blocks is spread over as many keys as there are shuffle partitions
    salts = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = parts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = salted.join(blocks.withColumn("salt", F.pmod(F.xxhash64("blob"), F.lit(salts)).cast("int")), ["dim", "salt"])
    sent = met.select("part", "dim", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("vec"), "n", "blob")
    arrow_score = {"double": pa.float64(), "long": pa.int64()}[score_type]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, search = None, [], [], None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "dim", "kind", "id", "n", "blob")]
            for i, (p, dim, kind, vec_id, n, blob) in enumerate(zip(*columns)):
                if (p, dim) != key:
                    key, ids, rows, search = (p, dim), [], [], None
                if kind == 0:
                    ids.append(vec_id)
                    rows.append(batch.column("vec")[i].values.to_numpy(zero_copy_only=False))
                    continue
                if search is None:
                    search = open_part(np.array(ids, np.int64), np.array(rows, np.float64))
                    ids, rows = [], []
                q, v, s = [], [], []
                for query_id, found, scores in search(*unpacked(blob, n)):
                    q.append(np.full(len(found), query_id, np.int64))
                    v.append(found)
                    s.append(scores)
                if q:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(q)), pa.array(np.concatenate(v)), pa.array(np.concatenate(s), arrow_score)], ["query_id", "vec_id", "score"])

    together = cand.unionByName(sent).repartition("part", "dim").sortWithinPartitions("part", "dim", "kind")
    return together.mapInArrow(run, f"query_id long, vec_id long, score {score_type}")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query over all parts, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
