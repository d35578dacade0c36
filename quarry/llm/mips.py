"""Exact top-k inner products (operator 9): norm-bucketed retrieval.

Vectors are grouped by length (norm): each part holds one band of norms, cut
into parts of bounded size, and inside a part into small buckets by falling
norm.  For a query with running k-th best score t, a bucket can hold a better
vector only if its cosine to the query reaches t / (|q| * longest norm).  If
that local threshold exceeds one, the bucket and all shorter ones are
skipped; if it is high, the query's largest coordinates bound the same
coordinates of any such vector (coordinate pruning); if it is low, only
vectors long enough are kept (length pruning).  What is left is verified by
its inner product, exact in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.vectors import best, search_parts, usable


@dataclass(frozen=True)
class Params:
    """Production parameters: size of a part and of a bucket, norm bands per doubling, coordinates looked at."""

    part: int = 8192
    bucket: int = 512
    bands: int = 4
    focus: int = 3
    coordinate_from: float = 0.6


class NormBuckets:
    """One part, by falling norm in buckets; ``search`` streams query blocks past it."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, p: Params):
        norms = np.sqrt((rows * rows).sum(1))
        order = np.lexsort((ids, -norms))
        self.ids, self.rows, self.norms = ids[order], rows[order], norms[order]
        self.unit = self.rows / np.maximum(self.norms, 1e-300)[:, None]
        self.k, self.p = k, p
        self.largest = float(np.abs(self.rows).max(initial=0.0))

    def _reach(self, norm, length: float):
        """No product with vectors of this norm is larger, rounding included."""
        return norm * length * (1 + 1e-12) + 1e-6

    def _products(self, at, q: np.ndarray) -> np.ndarray:
        """Exact products: in doubles where every partial sum is below 2^53, else in 64-bit integers."""
        if self.largest * float(np.abs(q).max(initial=0.0)) * len(q) < 2**53:
            return (self.rows[at] @ q).astype(np.int64)
        return self.rows[at].astype(np.int64) @ q.astype(np.int64)

    def _left(self, q: np.ndarray, length: float, unit: np.ndarray, focus: np.ndarray, at: slice, floor: float) -> np.ndarray:
        """Positions in the bucket that may beat ``floor``."""
        threshold = floor / (length * self.norms[at.start]) if length * self.norms[at.start] > 0 else -1.0
        if threshold > 1 + 1e-9:
            return np.zeros(0, np.int64)
        if threshold < self.p.coordinate_from:
            return at.start + np.flatnonzero(self._reach(self.norms[at], length) >= floor) if floor > 0 else np.arange(at.start, at.stop)
        keep = np.ones(at.stop - at.start, bool)
        t = min(threshold, 1.0)
        for f in focus:  # a unit vector with cosine t or more has this coordinate in between
            slack = np.sqrt(max(0.0, (1 - t * t) * (1 - unit[f] * unit[f]))) + 1e-9
            x = self.unit[at, f]
            if unit[f] > -t:
                keep &= x >= unit[f] * t - slack
            if unit[f] < t:
                keep &= x <= unit[f] * t + slack
        return at.start + np.flatnonzero(keep)

    def search(self, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        n, k = len(self.ids), self.k
        first = slice(0, min(n, self.p.bucket))
        lengths = np.sqrt((queries * queries).sum(1))
        for query_id, q, length in zip(query_ids, queries, lengths.tolist()):
            unit = q / max(length, 1e-300)
            focus = np.argsort(-np.abs(unit), kind="stable")[: self.p.focus]
            others = self.ids[first] != query_id
            ids, scores = self._top(self.ids[first][others], self._products(first, q)[others])  # the longest vectors set the first threshold
            for start in range(first.stop, n, self.p.bucket):
                floor = scores[-1] if len(ids) >= k else -np.inf
                at = slice(start, min(n, start + self.p.bucket))
                if floor > self._reach(self.norms[start], length):
                    break  # this bucket and all shorter ones
                left = np.arange(at.start, at.stop) if floor == -np.inf else self._left(q, length, unit, focus, at, floor)
                left = left[self.ids[left] != query_id]
                if len(left):
                    ids, scores = self._top(np.concatenate([ids, self.ids[left]]), np.concatenate([scores, self._products(left, q)]))
            if len(ids):
                yield int(query_id), ids, scores

    def _top(self, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) > 4 * self.k:
            worst = np.partition(scores, -self.k)[-self.k]
            ids, scores = ids[scores >= worst], scores[scores >= worst]
        order = np.lexsort((ids, -scores))[: self.k]
        return ids[order], scores[order]


def top_products(df: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", params: Params = Params()) -> DataFrame:
    """The k largest integer inner products of every ``every``-th vector with all others.

    Components x become floor(scale * x).  Returns query_id, rank, vec_id and
    score (long).  Vectors that are null, empty or hold null or non-finite
    components, and rows without id, take no part; zero vectors do.  A row
    with the query's id is the query's own; equal rows under other ids are
    candidates; with fewer candidates than k all are returned.  Products are
    exact while they and the components fit into 64 bits.
    """
    x = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).filter(F.col("id").isNotNull() & usable("vec"))
    x = x.select("id", F.transform("vec", lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("vec"))
    square = F.aggregate("vec", F.lit(0.0), lambda a, c: a + c * c)
    x = x.withColumn("band", F.floor(F.log2(F.greatest(square, F.lit(1.0))) * (params.bands / 2)).cast("long"))
    bands = x.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / params.part).alias("splits"))
    dealt = x.join(bands, "band").withColumn("part", F.struct("band", F.pmod(F.xxhash64("id"), F.col("splits")).alias("split")))
    part = F.xxhash64("part.band", "part.split")
    queries = x.filter(F.col("id") % every == 0).select("id", "vec")
    found = search_parts(dealt, part, queries, lambda ids, rows: NormBuckets(ids, rows, k, params).search, "long")
    return best(found, k)
