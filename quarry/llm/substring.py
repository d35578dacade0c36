"""Substring dedup (operator 3): count-min prefilter, then exact grouping of repeated windows.

A window is ``k`` consecutive words of one document.  The blocks' merged
sketches (``blocks``) overestimate how often a window occurs; only windows
estimated repeated go on, so none that does repeat is lost.  The second pass
groups them exactly, by 96 bits of hash: each block sends one entry per
distinct window (its own first occurrence) to the window's range, the range
finds the smallest document among the blocks, and the other blocks learn that
their copies start later.  Words covered by a window that starts earlier
elsewhere, or earlier in the block, go.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm import hashing
from quarry.llm.blocks import U, answered, documents_of, in_blocks, layout, look_up, pack_sorted, shared_counters, text_slices, unpack_sorted

SECOND = 0x5851F42D4C957F2D
KEYS = "r int, b int, n int, h1 binary, h2 binary, ids binary"
LOST = "b int, n int, h1 binary, h2 binary"
KEPT = "doc_id long, n_words long, n_removed long, kept string"


def _windows(table: pa.Table, k: int) -> np.ndarray:
    return np.concatenate([hashing.words(hashing.chars(texts)).windows(k)[1] for _, texts in text_slices(table)] or [np.zeros(0, U)])


def _two_hashes(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, first hash, second hash) of every window, in order."""
    docs, h1, h2 = [], [], []
    for first, texts in text_slices(table):
        w = hashing.words(hashing.chars(texts))
        at, one = w.windows(k)
        docs.append(first + np.searchsorted(w.last, at, side="right"))
        h1.append(one)
        h2.append((w.windows(k, SECOND)[1] >> U(32)).astype(np.uint32))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.uint32)
    return np.concatenate(docs), np.concatenate(h1), np.concatenate(h2)


def _first_of_each(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order by hash, then position; mark of each distinct pair's first place in that order)."""
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def remove_repeats(df: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words of its repeated windows: doc_id, n_words, n_removed, kept.

    ``kept`` is the remaining words joined by one space.  A window is repeated
    if its words also start earlier: in a smaller id, or earlier in the same
    document.  Windows are judged on the input.  A null id counts as smaller
    than all; rows with one id are ordered by a hash of their texts.  Null,
    empty and short texts lose nothing.
    """
    lay = layout(df, text_col)
    blocks = in_blocks(df, id_col, text_col, lay)
    repeated = shared_counters(blocks, lay, lambda table: _windows(table, k))
    least = np.iinfo(np.int64).min

    def keys(docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows = {"r": [], "b": [], "n": [], "h1": [], "h2": [], "ids": []}
        schema = pa.schema([("r", pa.int32()), ("b", pa.int32()), ("n", pa.int32()), ("h1", pa.binary()), ("h2", pa.binary()), ("ids", pa.binary())])
        if docs.num_rows and answers.num_rows:
            table = documents_of(docs.column("blob"))
            doc, h1, h2 = _two_hashes(table, k)
            found, _ = look_up(answered(answers)[0], lay.counter(h1))
            doc, h1, h2 = doc[found], h1[found], h2[found]
            order, new = _first_of_each(h1, h2)
            order = order[new]
            ids = table.column("doc_id").fill_null(least).to_numpy()[doc[order]]
            h1, h2 = h1[order], h2[order]
            cuts = lay.cuts(h1, 64)
            block = docs.column("b")[0].as_py()
            for r, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                if j > i:
                    for name, value in zip(rows, (r, block, j - i, pack_sorted(h1[i:j]), h2[i:j].tobytes(), ids[i:j].astype("<i8").tobytes())):
                        rows[name].append(value)
        return pa.table(rows, schema=schema)

    def judge(table: pa.Table) -> pa.Table:
        """For each block, its windows of which another block has the first occurrence."""
        rows = table.to_pylist()
        h1 = np.concatenate([unpack_sorted(x["h1"], x["n"]) for x in rows])
        h2 = np.concatenate([np.frombuffer(x["h2"], np.uint32) for x in rows])
        ids = np.concatenate([np.frombuffer(x["ids"], "<i8") for x in rows])
        block = np.repeat([x["b"] for x in rows], [x["n"] for x in rows])
        order = np.lexsort((block, ids, h2, h1))
        a, b = h1[order], h2[order]
        later = np.zeros(len(order), bool)
        later[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        lost = np.zeros(len(order), bool)
        lost[order] = later
        out, at = {"b": [], "n": [], "h1": [], "h2": []}, 0
        for x in rows:
            mine = slice(at, at + x["n"])
            at += x["n"]
            gone = lost[mine]
            if gone.any():
                for name, value in zip(out, (x["b"], int(gone.sum()), pack_sorted(h1[mine][gone]), h2[mine][gone].tobytes())):
                    out[name].append(value)
        return pa.table(out, schema=pa.schema([("b", pa.int32()), ("n", pa.int32()), ("h1", pa.binary()), ("h2", pa.binary())]))

    def strip(docs: pa.Table, lost: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        if not docs.num_rows:
            return pa.table(out, schema=schema)
        table = documents_of(docs.column("blob"))
        doc, h1, h2 = _two_hashes(table, k)
        order, new = _first_of_each(h1, h2)
        later = np.zeros(len(h1), bool)
        later[order] = ~new
        known = sorted(lost.to_pylist(), key=lambda x: unpack_sorted(x["h1"][:9], 1)[0])  # ranges do not overlap
        if known:
            gone1 = np.concatenate([unpack_sorted(x["h1"], x["n"]) for x in known])
            gone2 = np.concatenate([np.frombuffer(x["h2"], np.uint32) for x in known])
            found, at = look_up(gone1, h1)
            hit = np.flatnonzero(found)
            same = gone2[at[hit]] == h2[hit]
            later[hit[same]] = True
            for i in hit[~same]:  # one first hash, several second ones
                j = at[i]
                while j < len(gone1) and gone1[j] == h1[i]:
                    later[i] |= gone2[j] == h2[i]
                    j += 1
        cuts = np.searchsorted(doc, np.arange(table.num_rows + 1))
        for i, (doc_id, text) in enumerate(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist())):
            words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at exactly the six blanks
            starts = np.flatnonzero(later[cuts[i] : cuts[i + 1]])
            kept = words
            if len(starts):
                steps = np.zeros(len(words) + 1, np.int32)
                steps[starts] += 1
                steps[starts + k] -= 1
                kept = list(itertools.compress(words, (np.cumsum(steps[:-1]) == 0).tolist()))
            for name, value in zip(out, (doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass"))):
                out[name].append(value)
        return pa.table(out, schema=schema)

    sent = blocks.groupBy("b").cogroup(repeated.groupBy("b")).applyInArrow(keys, KEYS)
    lost = sent.groupBy("r").applyInArrow(judge, LOST)
    return blocks.groupBy("b").cogroup(lost.groupBy("b")).applyInArrow(strip, KEPT)
