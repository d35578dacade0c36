"""Approximate nearest neighbours (operator 4): randomly rotated one-bit codes.

A vector's direction is turned by a seeded random rotation into ``bits``
dimensions and kept as its signs alone, packed 64 to a word, with two
correction scalars: its length and the inner product of the direction with
its own sign vector.  A rotated query is rounded to ``planes`` bits a
dimension and cut into bit planes, so its product with a sign vector is a sum
of population counts of ``code AND plane``.  From that and the scalars the inner
product is estimated; its error is bounded by ``epsilon`` standard deviations
of the code's and by what the rounding can cost at most.  The exact products
of the most promising codes give a k-th best score; every vector whose
estimate plus bound reaches it is reranked by its exact product, which is
summed in one fixed order, so equal vectors score alike wherever they lie.
All rows are coded; nothing is fitted.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.vectors import best, search_parts, usable


@dataclass(frozen=True)
class Params:
    """Production parameters: part size, code bits per dimension, bits of a rounded query, error margin, codes tried first per result."""

    part: int = 8192
    bits_per_dim: int = 4
    planes: int = 6
    epsilon: float = 4.0
    first: int = 2
    seed: int = 31


@functools.lru_cache(maxsize=8)
def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """``bits`` x ``dim`` matrix with orthonormal columns, the same wherever it is made."""
    gauss = np.random.default_rng([seed, dim, bits]).standard_normal((bits, dim))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def code_bits(dim: int, p: Params) -> int:
    return max(64, -(-dim * p.bits_per_dim // 64) * 64)


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in one fixed order of additions: equal rows have equal products."""
    x = rows * query
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        x = np.concatenate([x[:, :half] + x[:, half : 2 * half], x[:, 2 * half :]], 1)
    return x[:, 0]


def words_of(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as rows of 64-bit words."""
    return np.packbits(bits, axis=-1).view(np.uint64)


@dataclass
class Codes:
    """Packed sign bits of rotated directions, with their two correction scalars and the number of ones."""

    packed: np.ndarray
    ones: np.ndarray
    length: np.ndarray
    own: np.ndarray
    bits: int

    def products(self, turned: np.ndarray, planes: int) -> tuple[np.ndarray, float]:
        """Products of the rounded query with every sign vector, and how far rounding can have moved them."""
        low = float(turned.min())
        step = (float(turned.max()) - low) / ((1 << planes) - 1) or 1.0
        whole = np.rint((turned - low) / step).astype(np.uint16)
        total = np.zeros(len(self.packed), np.int64)
        for i in range(planes):
            plane = words_of((whole >> i & 1).astype(np.uint8))
            total += np.bitwise_count(self.packed & plane).sum(1, dtype=np.int64) << i
        rounded = low + step * whole
        return 2 * (low * self.ones + step * total) - rounded.sum(), float(np.abs(turned - rounded).sum())


def encode(rows: np.ndarray, p: Params = Params()) -> Codes:
    """Codes of non-zero vectors of one dimension."""
    bits = code_bits(rows.shape[1], p)
    length = np.sqrt((rows * rows).sum(1))
    turned = (rows / length[:, None]) @ rotation(rows.shape[1], bits, p.seed).T
    packed = words_of((turned > 0).astype(np.uint8))
    return Codes(packed, np.bitwise_count(packed).sum(1, dtype=np.int64), length, np.abs(turned).sum(1) / np.sqrt(bits), bits)


class CodedPart:
    """One part: codes for estimates, original vectors for reranking; ``seen`` and ``reranked`` count rows met and rows multiplied out."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, p: Params):
        self.ids, self.rows, self.k, self.p = ids, rows, k, p
        self.codes = encode(rows, p)
        self.scale = self.codes.length / (self.codes.own * np.sqrt(self.codes.bits))
        self.spread = self.codes.length * np.sqrt(np.maximum(0, 1 - self.codes.own**2)) / self.codes.own * p.epsilon / np.sqrt(self.codes.bits - 1)
        self.seen = self.reranked = 0

    def search(self, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        turned = queries @ rotation(queries.shape[1], self.codes.bits, self.p.seed).T
        lengths = np.sqrt((queries * queries).sum(1))
        first = self.k * self.p.first + 1
        for query_id, q, t, length in zip(query_ids, queries, turned, lengths):
            self.seen += len(self.ids)
            if len(self.ids) > first:
                products, off = self.codes.products(t, self.p.planes)
                estimate = products * self.scale
                tried = np.argpartition(-estimate, first)[:first]
                tried = tried[self.ids[tried] != query_id]
                near = exact(self.rows[tried], q)
                floor = np.partition(near, -self.k)[-self.k] if len(near) >= self.k else -np.inf
                chosen = np.flatnonzero(estimate + self.spread * length + off * self.scale >= floor)
                # the k that set the floor are never left out by a bound that failed
                chosen = np.union1d(chosen, tried[near >= floor])
            else:
                chosen = np.arange(len(self.ids))
            chosen = chosen[self.ids[chosen] != query_id]
            self.reranked += len(chosen)
            scores = exact(self.rows[chosen], q)
            order = np.lexsort((self.ids[chosen], -scores))[: self.k]
            if len(order):
                yield int(query_id), self.ids[chosen][order], scores[order]


def nearest(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", params: Params = Params()) -> DataFrame:
    """The k vectors with the largest inner product with every ``every``-th vector.

    Returns query_id, rank, vec_id and score, the exact double product of the
    original vectors.  Vectors that are null, empty, zero or hold null or
    non-finite components, and rows without id, take no part.  A row with the
    query's id is the query's own; equal rows under other ids are candidates,
    ties going to the smaller id; with fewer candidates than k all are returned.
    """
    x = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    x = x.filter(F.col("id").isNotNull() & usable("vec")).filter(F.exists("vec", lambda c: c != 0))
    parts = x.agg(F.ceil(F.count(F.lit(1)) / params.part).alias("n")).first()["n"] or 1
    part = F.pmod(F.xxhash64("id"), F.lit(parts))
    queries = x.filter(F.col("id") % every == 0)
    found = search_parts(x, part, queries, lambda ids, rows: CodedPart(ids, rows, k, params).search, "double")
    return best(found, k)
