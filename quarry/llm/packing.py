"""Sequence packing (operator 2): first-fit decreasing over a tournament tree of bin capacities.

Documents are tokenised in one scan; each is cut into full pieces of
``capacity`` ids and one remainder.  Documents are dealt to seeded random
groups; inside a group, first-fit decreasing places every piece in the first
sequence with room, found by descending a max-tournament tree over the
sequences' free capacities in O(log n).  Only lengths and checksums are
shuffled (``payload="crc32"``) unless the ids themselves are asked for.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import id_text, slices, texts_of

END_ID = 1
CAPACITY = 2048
GROUP_DOCS = 4096


@functools.lru_cache(maxsize=4)
def byte_bpe(ranks_path: str, pattern: str, special: tuple[tuple[str, int], ...]):
    """Byte-level BPE encoder of a public vocabulary file, built once per worker."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def default_vocabulary() -> dict:
    """The public 50k byte-level BPE: ids equal those of ``tokenizers`` on ``byte_bpe_50k.json``."""
    import public_tokenizers

    return {
        "ranks_path": public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
        "special": (("<|endoftext|>", 50256),),
    }


class CapacityTree:
    """Max-tournament tree over bin capacities: ``first_fit`` finds the leftmost bin with room."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (max(bins, 1) - 1).bit_length())
        self.tree = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Take ``size`` from the leftmost bin that holds it and return that bin; -1 if none does."""
        tree, node = self.tree, 1
        if tree[1] < size:
            return -1
        while node < self.leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        tree[node] -= size
        found = node - self.leaves
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
        return found


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, longest first (ties in the given order)."""
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    tree = CapacityTree(len(sizes), capacity)
    used: dict[int, int] = {}
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        b = tree.first_fit(size)
        bins[i], offsets[i] = b, used.get(b, 0)
        used[b] = offsets[i] + size
    return bins, offsets


PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("__row", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)
PIECE_DDL = "doc_id long, __row long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"


def pieces(df: DataFrame, id_col: str, text_col: str, capacity: int, vocabulary: dict, with_ids: bool) -> DataFrame:
    """One row per piece of every document's ids (with the end id); ``ids`` is null without ``with_ids``."""
    path, pattern, special = vocabulary["ranks_path"], vocabulary["pattern"], tuple(vocabulary["special"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = byte_bpe(path, pattern, special), 0
        allowed = {s for s, _ in special}
        for batch in slices(batches):
            out = {f.name: [] for f in PIECE}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                row += 1
                ids = np.append(encoder.encode_to_numpy(text, allowed_special=allowed), np.uint32(END_ID)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    part = ids[start : start + capacity]
                    for name, value in zip(out, (doc_id, row, start, len(part), zlib.crc32(part.tobytes()), len(ids), part.astype(np.int32) if with_ids else None)):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=PIECE)

    return id_text(df, id_col, text_col).mapInArrow(cut, PIECE_DDL)


PACKED_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    group_docs: int = GROUP_DOCS,
    seed: int = 11,
    vocabulary: dict | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` ids.

    Returns one row per piece: doc_id, start (ids of the document before it),
    length, ids_crc32 (of its little-endian unsigned 32-bit ids), doc_tokens
    (ids of the document with the end id), sequence_id, offset in the
    sequence (gapless from 0) and, on request, the ids.

    Null and empty texts are the end id alone; a null id is kept; rows with
    the same id are separate documents; a document of any length is cut
    freely; equal lengths are placed in the order of id, row and start.
    """
    groups = max(1, -(-df.count() // group_docs))
    cut = pieces(df, id_col, text_col, capacity, vocabulary or default_vocabulary(), with_ids)
    # the row number in its task keeps many rows of one id (or of none) apart
    cut = cut.withColumn("__group", F.pmod(F.xxhash64("doc_id", "__row", F.lit(seed)), F.lit(groups)))
    schema = pa.schema([*(f for f in PIECE if f.name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("__row", "ascending"), ("ids_crc32", "ascending"), ("start", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), capacity)
        group = table.column("__group")[0].as_py() if table.num_rows else 0
        table = table.append_column("sequence_id", pa.array(bins + (group << 32))).append_column("offset", pa.array(offsets))
        return table.select(schema.names).cast(schema)

    packed = cut.groupBy("__group").applyInArrow(fill, PACKED_DDL)
    return packed if with_ids else packed.drop("ids")
