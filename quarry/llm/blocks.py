"""Blocks of documents and the count-min sketch that all blocks share.

Documents are dealt once, by a hash of id and text, to blocks of bounded size;
a block travels as zstd-compressed Arrow.  Hashes of word runs are counted
across blocks in two shuffles of packed arrays, without a row per run and
without a broadcast:

1. every block sketches its own runs: a count-min sketch of one row, so wide
   that only the counters in use are kept, as sorted counter numbers and
   counts; the sketch is cut by counter range and sent to the range;
2. every range adds up the counters of all blocks and sends back to each
   block those of its counters that reached two, with their totals.

A total is never below the true count, so a run that occurs twice anywhere
is always among the answers; the width grows with the input, which keeps
the share of false answers alike at every size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import MB, slices

U = np.uint64
BLOCK_BYTES = 10 * MB  # of text
MANY_BLOCKS = 8192
SLICE = MB  # text hashed at a time


# ------------------------------------------------------------- packed arrays


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers: the first, the width of a gap, then the gaps' bytes plane by plane."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return values[:1].astype("<u8").tobytes() + bytes([width]) + np.ascontiguousarray(planes).tobytes()


def unpack_sorted(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, U)
    width = blob[8]
    gaps = np.zeros((n - 1, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(width, n - 1).T
    out = np.empty(n, U)
    out[0] = np.frombuffer(blob, "<u8", 1)[0]
    out[1:] = gaps.view("<u8").ravel()
    return np.cumsum(out, dtype=U)


# ------------------------------------------------------------------ documents


@dataclass(frozen=True)
class Layout:
    """How many blocks and counter ranges there are, and how wide the sketch is."""

    blocks: int
    ranges: int
    bits: int

    def counter(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> U(64 - self.bits)

    def cuts(self, sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
        """Where each range begins among ascending numbers of ``bits`` bits."""
        edges = np.array([(r << bits) // self.ranges for r in range(1, self.ranges)], U)
        return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


def layout(docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES) -> Layout:
    """Blocks in proportion to the bytes of text, which one aggregate measures; 2^6 counters per byte.

    Every block sends to every range, so beyond ``MANY_BLOCKS`` the number of
    blocks and their size grow alike, with the square root of the input.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long") + 16)).first()[0] or 1
    blocks = max(8, size // block_bytes)
    if blocks > MANY_BLOCKS:
        blocks = int(math.sqrt(blocks * MANY_BLOCKS))
    return Layout(blocks, blocks, min(56, max(24, math.ceil(math.log2(size)) + 6)))


def in_blocks(docs: DataFrame, id_col: str, text_col: str, lay: Layout) -> DataFrame:
    """(b, blob): the documents of a block as compressed Arrow batches of (doc_id, tie, text)."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(lay.blocks)).cast("int"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in slices(batches, limit=8 * MB):
            table = pa.Table.from_batches([batch])
            b = table.column("b").to_numpy()
            order = np.argsort(b, kind="stable")
            cuts = np.flatnonzero(np.diff(b[order], prepend=-1))
            for at, stop in zip(cuts, [*cuts[1:], len(order)]):
                part = table.select(["doc_id", "tie", "text"]).take(pa.array(order[at:stop])).combine_chunks()
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_table(part)
                yield pa.RecordBatch.from_arrays([pa.array([b[order[at]]], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["b", "blob"])

    return rows.mapInArrow(pack, "b int, blob binary")


def documents_of(blobs: pa.ChunkedArray) -> pa.Table:
    """The documents of a block by id (null first) and tie, as (doc_id, tie, text)."""
    tables = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in blobs]
    table = pa.concat_tables(tables)
    order = pc.sort_indices(table, [("doc_id", "ascending"), ("tie", "ascending")], null_placement="at_start")
    return table.take(order)


def text_slices(table: pa.Table, limit: int = SLICE) -> Iterator[tuple[int, list[str]]]:
    """(number of the first document, texts) of slices of bounded text; null texts are empty."""
    texts = table.column("text").to_pylist()
    start, held = 0, 0
    for i, t in enumerate(texts):
        texts[i] = t = t or ""
        if held and held + len(t) > limit:
            yield start, texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, texts[start:]


# ------------------------------------------------------------------ the sketch

COUNTS = "r int, b int, n int, counters binary, counts binary"
ANSWERS = "b int, n int, counters binary, totals binary"


def shared_counters(blocks: DataFrame, lay: Layout, hashes: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """``ANSWERS`` rows: per block and range, the block's counters whose total over all blocks is two or more.

    ``hashes`` gives the hashes of a block's documents, repeated as often as they count.
    """

    def sketch(table: pa.Table) -> pa.Table:
        counters = np.sort(lay.counter(hashes(documents_of(table.column("blob")))))
        first = np.flatnonzero(np.diff(counters, prepend=U(1 << 63)) != 0) if len(counters) else np.zeros(0, np.int64)
        counts = np.minimum(np.diff(np.append(first, len(counters))), 255).astype(np.uint8)
        counters = counters[first]
        rows = {"r": [], "b": [], "n": [], "counters": [], "counts": []}
        cuts = lay.cuts(counters, lay.bits)
        block = table.column("b")[0].as_py()
        for r, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
            if j > i:
                for name, value in zip(rows, (r, block, j - i, pack_sorted(counters[i:j]), counts[i:j].tobytes())):
                    rows[name].append(value)
        return pa.table(rows, schema=pa.schema([("r", pa.int32()), ("b", pa.int32()), ("n", pa.int32()), ("counters", pa.binary()), ("counts", pa.binary())]))

    def add(table: pa.Table) -> pa.Table:
        rows = table.select(["b", "n", "counters", "counts"]).to_pylist()
        counters = np.concatenate([unpack_sorted(x["counters"], x["n"]) for x in rows])
        counts = np.concatenate([np.frombuffer(x["counts"], np.uint8) for x in rows])
        order = np.argsort(counters, kind="stable")
        first = np.flatnonzero(np.diff(counters[order], prepend=U(1 << 63)) != 0)
        totals = np.add.reduceat(counts[order].astype(np.int64), first)
        total = np.empty(len(counters), np.int64)
        total[order] = np.repeat(totals, np.diff(np.append(first, len(counters))))
        out, at = {"b": [], "n": [], "counters": [], "totals": []}, 0
        for x in rows:
            mine = slice(at, at + x["n"])
            at += x["n"]
            keep = total[mine] >= 2
            if keep.any():
                shown = np.minimum(total[mine][keep], 65535).astype("<u2")
                for name, value in zip(out, (x["b"], int(keep.sum()), pack_sorted(counters[mine][keep]), shown.tobytes())):
                    out[name].append(value)
        return pa.table(out, schema=pa.schema([("b", pa.int32()), ("n", pa.int32()), ("counters", pa.binary()), ("totals", pa.binary())]))

    return blocks.groupBy("b").applyInArrow(sketch, COUNTS).groupBy("r").applyInArrow(add, ANSWERS)


def answered(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A block's shared counters, ascending, and their totals."""
    rows = table.select(["n", "counters", "totals"]).to_pylist()
    if not rows:
        return np.zeros(0, U), np.zeros(0, np.int64)
    counters = [unpack_sorted(x["counters"], x["n"]) for x in rows]
    totals = [np.frombuffer(x["totals"], "<u2").astype(np.int64) for x in rows]
    order = np.argsort([c[0] for c in counters])  # ranges do not overlap
    return np.concatenate([counters[i] for i in order]), np.concatenate([totals[i] for i in order])


def look_up(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, position) of each wanted number among ascending keys."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return sorted_keys[at] == wanted, at
