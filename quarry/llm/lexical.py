"""Ranked lexical search (operator 12): documents grouped by which terms of an item they hold.

1. One scan counts the terms of every document; of the terms, only those of
   the items are kept, as numbers with their counts, and written once.
2. Three sums over that table give the number of documents, their length and
   every term's document frequency, hence its weight.
3. A second pass reads the written table in blocks.  Per block and item,
   bitmap operations give each document the mask of the item's terms it holds
   (one bit a term), and documents with one mask form a group.  A mask's
   maximum score is the sum of its terms' largest contributions in the block.
   Masks are evaluated by descending maximum, and when the next maximum is
   below the item's k-th best score so far, no other document of the block can
   enter and the item is finished there.  The k-th best is kept for the whole
   task, so later blocks start with a high bar.
4. A task returns at most ``top`` documents per item; these meet in two
   rounds, by (item, group of tasks) and by item.

Every document with a term counts in all sums; nothing is sampled.  The items
are the query set: they go to every task in blocks of ``item_bytes`` of text,
one pass over the documents per block, so what a task holds has a bound
(one item's own terms at least).
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import MB, id_text, slices, written

# lower case for A-Z, blanks for what no term holds; every byte of a non-ASCII character is part of a term
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item_id long, doc_id long, score long"


@dataclass(frozen=True)
class Params:
    """``top`` documents an item; the score's constants; how much is held at once."""

    top: int = 50
    k: int = 20  # weight of the length against 1000 per occurrence
    b: int = 50  # share of the length, of 100, that depends on the document's own
    item_bytes: int = 8 * MB
    block_rows: int = 4096
    slice_bytes: int = MB


def terms_of(data: bytes, slice_bytes: int = MB) -> Iterator[list[bytes]]:
    """The terms of a text, a list per slice of bounded size (a longer term is a slice of its own)."""
    data = data.translate(TERM_BYTES)
    at = 0
    while at < len(data):
        stop = at + slice_bytes
        if stop < len(data):
            stop = data.find(b" ", stop)
            stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


def postings(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text_col: str, slice_bytes: int) -> DataFrame:
    """``POSTINGS``: per document its number of terms and the numbers and counts of those in ``numbers``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, terms, tfs, ends = [], [], [], [0]
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                total, held = 0, Counter()
                for some in terms_of(data or b"", slice_bytes):
                    total += len(some)
                    held.update(filter(numbers.__contains__, some))
                n.append(total)
                terms.extend(map(numbers.__getitem__, held))
                tfs.extend(held.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return id_text(docs, id_col, text_col).mapInArrow(work, POSTINGS)


class Best:
    """The best documents of one item so far: score, whether the id is null, id; best first."""

    def __init__(self, top: int):
        self.top = top
        self.rows = np.zeros((0, 3), np.int64)

    @property
    def bar(self) -> int:
        """A document must reach this score to enter."""
        return int(self.rows[-1, 0]) if len(self.rows) >= self.top else 1

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate([self.rows, np.stack([score, null, ids], 1)])
        rows = rows[rows[:, 0] > 0]
        self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[: self.top]]


class Ranker:
    """Ranks blocks of postings for all items; ``masks`` and ``evaluated`` count groups found and groups scored."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, documents: int, total_terms: int, params: Params):
        self.items = [t[weights[t] > 0] for t in items]  # a term without weight adds nothing
        self.weights, self.documents, self.total, self.params = weights, documents, total_terms, params
        self.best = [Best(params.top) for _ in items]
        self.bit = np.full(len(weights), -1, np.int64)  # a term's place in the item at hand
        self.masks = self.evaluated = 0

    def block(self, null: np.ndarray, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        """Documents ``ids`` with ``n`` terms each; document i has the postings ``ends[i]:ends[i + 1]``."""
        p, rows = self.params, len(ids)
        length = np.array([100 - p.b + (p.b * x * self.documents) // self.total for x in n.tolist()], np.int64)
        row = np.repeat(np.arange(rows), np.diff(ends))
        tf = tfs.astype(np.int64)
        value = self.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + p.k * length[row]))
        order = np.argsort(terms, kind="stable")
        by_row, by_value = row[order], value[order]
        first = np.zeros(len(self.weights) + 1, np.int64)
        np.cumsum(np.bincount(terms, minlength=len(self.weights)), out=first[1:])
        largest = np.zeros(len(self.weights), np.int64)
        seen = np.flatnonzero(np.diff(first))
        if len(seen):
            largest[seen] = np.maximum.reduceat(by_value, first[seen])
        for mine, best in zip(self.items, self.best):
            most = largest[mine]
            if int(most.sum()) < best.bar:
                continue
            mask = np.zeros((rows, (len(mine) + 63) // 64), np.uint64)
            for j, t in enumerate(mine.tolist()):
                mask[by_row[first[t] : first[t + 1]], j >> 6] |= np.uint64(1 << (j & 63))
            self._masks(mine, most, best, mask, null, ids, ends, terms, value)

    def _masks(self, mine, most, best, mask, null, ids, ends, terms, value) -> None:
        held = np.flatnonzero(mask.any(1))
        if not len(held):
            return
        mask = mask[held]
        keys = mask[:, 0] if mask.shape[1] == 1 else mask.view([("", np.uint64)] * mask.shape[1])[:, 0]
        _, one, group = np.unique(keys, return_index=True, return_inverse=True)
        bits = np.unpackbits(mask[one].astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : len(mine)]
        bound = bits.astype(np.int64) @ most
        self.masks += len(bound)
        falling = np.argsort(-bound, kind="stable")
        members = held[np.argsort(group, kind="stable")]
        sizes = np.bincount(group, minlength=len(bound))
        start = np.cumsum(sizes) - sizes
        self.bit[mine] = np.arange(len(mine))
        at, wanted = 0, best.top
        while at < len(falling) and bound[falling[at]] >= best.bar:
            stop = at + max(1, int(np.searchsorted(np.cumsum(sizes[falling[at:]]), wanted)))
            some = falling[at:stop]
            some = some[bound[some] >= best.bar]
            docs = np.concatenate([members[start[g] : start[g] + sizes[g]] for g in some.tolist()])
            best.add(self._scores(docs, ends, terms, value), null[docs], ids[docs])
            self.evaluated += len(some)
            at, wanted = stop, wanted * 2
        self.bit[mine] = -1

    def _scores(self, docs: np.ndarray, ends: np.ndarray, terms: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Scores of documents for the item at hand, from their own postings."""
        count = ends[docs + 1] - ends[docs]
        place = np.repeat(ends[docs] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        counts = np.where(self.bit[terms[place]] >= 0, value[place], 0)
        return np.add.reduceat(counts, np.cumsum(count) - count)  # every document here has postings


def rank(held: DataFrame, item_ids: list[int | None], ranker_of, params: Params) -> DataFrame:
    """``FOUND``: each task's best documents for every item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = ranker_of()
        for batch in batches:
            for start in range(0, batch.num_rows, params.block_rows):
                some = batch.slice(start, params.block_rows)
                ids, lists = some.column("doc_id"), some.column("terms")
                ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                terms, tfs = (some.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("terms", "tfs"))
                ranker.block(ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(0).to_numpy(), some.column("n").to_numpy(), ends, terms, tfs)
        rows = [(i, None if null else doc, score) for i, best in zip(item_ids, ranker.best) for score, null, doc in best.rows.tolist()]
        if rows:
            items, docs, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

    return held.mapInArrow(work, FOUND)


def merged(found: DataFrame, top: int) -> DataFrame:
    """The best of all tasks: first within groups of tasks, then per item, so no task reads the answers of all."""
    falling = [F.desc("score"), F.asc_nulls_last("doc_id")]
    group = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(256)))
    near = group.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*falling))).filter(F.col("rank") <= top)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*falling))).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", params: Params = Params()) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``params.top`` documents of highest score for every item.

    A null text has no terms.  Rows that share an item id are one item with the
    terms of all of them; the rows without an id are one item too.  Every row
    of ``docs`` is a document, repeated ids included; equal scores come by
    ascending id, rows without an id last.  Items that no document reaches with
    a score above 0, and empty tables, give no rows.
    """
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter(F.col("text").isNotNull())
    size = asked.agg(F.sum(F.octet_length("text").cast("long") + 16)).first()[0] or 0
    blocks = -(-size // params.item_bytes)
    parts = []
    for b in range(blocks):
        some = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        terms: dict[int | None, set[bytes]] = {}
        for row in some.collect():  # a block of items, of bounded size
            terms.setdefault(row["item_id"], set()).update(*terms_of(row["text"].encode()))
        numbers = {t: i for i, t in enumerate(sorted(set().union(*terms.values())))}
        if not numbers:
            continue
        held = written(postings(docs, numbers, id_col, text_col, params.slice_bytes), "lexical-postings")
        total = held.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
        if not total["documents"]:
            break
        df = np.zeros(len(numbers), np.int64)
        for row in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term of the items
            df[row["t"]] = row["count"]
        weights = np.array([math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        wanted = [np.array(sorted(numbers[t] for t in mine), np.int64) for mine in terms.values()]
        counts = total["documents"], total["terms"]

        def ranker(wanted=wanted, weights=weights, counts=counts) -> Ranker:
            return Ranker(wanted, weights, *counts, params)

        parts.append(merged(rank(held.filter(F.size("terms") > 0), list(terms), ranker, params), params.top))
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionByName, parts)
