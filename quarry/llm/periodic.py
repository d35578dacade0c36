"""Periodic runs of words (operator 11) by online dyadic square catching.

Words are appended one after the other, or many at a time with the same
result.  Whenever a block of 2^l words is completed, a catcher is set on it for
the periods p of its level, 2^l <= p < 2^(l+1): it catches those p for which
the block repeats the words p places before it.  What is caught is compared on:
backwards at once, forwards with every word appended, until a word differs from
the one p places before.  As soon as the stretch is 2p words long, each further
word ends one more square of period p; squares of one period that follow each
other are one run, so a later block that matches within the stretch merges
into it.

* A run of period p that is long enough, at least max(24, 3p) words, has 2p or
  more places that repeat the place p before, and so holds a whole aligned
  block of its level: none is missed.  The lowest level has blocks of 8 words
  and the periods 1 to 15, for which the least length leaves 16 such places.
* Blocks are compared by polynomial hashes of windows, a level at a time; the
  comparisons that follow are on the words themselves.
* Where a known stretch of smaller period q <= 2^l covers both the block and
  its earlier copy, the period caught is a multiple of a smaller one (Fine and
  Wilf), and nothing is compared.  So a level costs what its words cost, also
  in a text of one word.
* A stretch whose period is a multiple of its smallest has the same ends as
  the run of the smallest period; per pair of ends the smallest stays.

The texts of a batch are appended after one another, longest first, each
followed by a word that occurs nowhere else; levels that are too high for a
text are not run on it.  Nothing is shuffled: a text is a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import hashing
from quarry.llm.common import id_text, slices

U = np.uint64
LOWEST = 3  # blocks of 8 words
LEAST, POWER = 24, 3  # a run has this many words and this many times its period
CELLS = 1 << 20  # window comparisons at a time
Run = tuple[int, int, int]  # start, length, period


class Catchers:
    """Words appended so far (as numbers), the stretches caught in them and those still growing."""

    def __init__(self) -> None:
        self.n = 0
        self.words = np.zeros(64, np.int64)
        self.sums = np.zeros(65, U)
        self.done: dict[int, int] = {}  # per level, blocks that have had their catcher
        self.last: dict[int, list[int]] = {}  # per period, the latest stretch [start, end, period]
        self.caught: list[list[int]] = []
        self.growing: list[list[int]] = []

    def append(self, words: np.ndarray, highest: int | None = None) -> None:
        """Append words; catchers of levels up to ``highest`` (all that can matter, if None) are set on completed blocks."""
        self._store(words)
        for stretch in self.growing:
            stretch[1] = self._forward(stretch[1], stretch[2])
        self.growing = [s for s in self.growing if s[1] == self.n]
        if highest is None:
            highest = highest_level(self.n)
        for level in range(LOWEST, highest + 1):
            self._complete(level)

    def runs(self) -> list[Run]:
        """Runs of the words so far: (start, length, smallest period), by start and period."""
        best: dict[tuple[int, int], int] = {}
        for start, end, period in self.caught:
            if end - start >= max(LEAST, POWER * period):
                best[start, end] = min(period, best.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in best.items())

    def _store(self, words: np.ndarray) -> None:
        n = self.n + len(words)
        if n > len(self.words):
            size = max(n, 2 * len(self.words))
            self.words = np.concatenate([self.words[: self.n], np.zeros(size - self.n, np.int64)])
            self.sums = np.concatenate([self.sums[: self.n + 1], np.zeros(size - self.n, U)])
        self.words[self.n : n] = words
        up, _ = hashing._WORDS.get(n + 1)
        values = hashing.mix(np.asarray(words, np.int64).view(U) + U(0x9E3779B97F4A7C15)) * up[self.n : n]
        np.cumsum(values, out=self.sums[self.n + 1 : n + 1], dtype=U)
        self.sums[self.n + 1 : n + 1] += self.sums[self.n]
        self.n = n

    def _forward(self, at: int, period: int) -> int:
        """The first place from ``at`` on that differs from the place ``period`` before it, or the end."""
        step, w = 32, self.words
        while at < self.n:
            stop = min(self.n, at + step)
            differ = w[at:stop] != w[at - period : stop - period]
            k = int(differ.argmax())
            if differ[k]:
                return at + k
            at, step = stop, step * 2
        return at

    def _backward(self, at: int, period: int) -> int:
        """The first place of the stretch before ``at`` whose words equal those ``period`` before them."""
        step, w = 32, self.words
        while at > period:
            start = max(period, at - step)
            differ = (w[start:at] != w[start - period : at - period])[::-1]
            k = int(differ.argmax())
            if differ[k]:
                return at - k
            at, step = start, step * 2
        return at

    def _complete(self, level: int) -> None:
        size = 1 << level
        low, high = (1, 2 * size) if level == LOWEST else (size, 2 * size)
        done, now = self.done.get(level, 0), self.n // size
        self.done[level] = now
        periods = np.arange(low, high)
        _, down = hashing._WORDS.get(self.n + 1)
        step = max(1, CELLS // len(periods))
        for begin in range(done, now, step):
            stop = min(now, begin + step)
            blocks = np.arange(begin, stop) * size
            first, last = max(0, begin * size - high), (stop - 1) * size + 1
            windows = (self.sums[first + size : last + size] - self.sums[first:last]) * down[first:last]
            earlier = blocks[:, None] - periods
            match = (windows[blocks - first][:, None] == windows[np.maximum(earlier, first) - first]) & (earlier >= 0)
            if not match.any():
                continue
            if level > LOWEST:
                match &= earlier < self._covered(begin, stop, size)[:, None]
            for b, p in zip(*(x.tolist() for x in np.nonzero(match))):
                self._catch(int(blocks[b]), size, int(periods[p]))

    def _covered(self, begin: int, stop: int, size: int) -> np.ndarray:
        """Per block, the first place of a stretch of period ``size`` or less that holds the block."""
        out = np.full(stop - begin, 1 << 62, np.int64)
        for start, end, period in self.caught:
            i, j = max(begin, -(-start // size)), min(stop, end // size)
            if i < j and period <= size:
                mine = out[i - begin : j - begin]
                np.minimum(mine, start, out=mine)
        return out

    def _catch(self, block: int, size: int, period: int) -> None:
        before = self.last.get(period)
        if before and before[1] > block:
            return  # the block's squares belong to the stretch caught before
        end = self._forward(block, period)
        if end < block + size:
            return  # equal hashes of different words
        stretch = [self._backward(block, period) - period, end, period]
        self.last[period] = stretch
        self.caught.append(stretch)
        if end == self.n:
            self.growing.append(stretch)


def highest_level(words: int) -> int:
    """The highest level whose periods fit ``POWER`` times into so many words; the lowest at least."""
    return max(LOWEST, (words // POWER).bit_length() - 1)


def runs_of(texts: list[list]) -> list[list[Run]]:
    """The runs of each list of words."""
    numbers: dict = {}
    catchers, place = Catchers(), [0] * len(texts)
    order = sorted((i for i, t in enumerate(texts) if len(t) >= LEAST), key=lambda i: -len(texts[i]))
    waiting, level, at = [], None, 0
    for k, i in enumerate(order):
        mine = highest_level(len(texts[i]))
        if waiting and mine != level:
            catchers.append(np.concatenate(waiting), level)
            waiting = []
        level, place[i] = mine, at
        waiting.append(np.array([numbers.setdefault(w, len(numbers)) for w in texts[i]] + [-1 - k], np.int64))
        at += len(texts[i]) + 1
    if waiting:
        catchers.append(np.concatenate(waiting), level)
    out: list[list[Run]] = [[] for _ in texts]
    starts = np.array([place[i] for i in order], np.int64)
    for start, length, period in catchers.runs():
        i = order[int(np.searchsorted(starts, start, "right")) - 1]
        out[i].append((start - place[i], length, period))
    return out


def kept(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop)) if not d]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length in periods, exactly; of equals the first, then the one of smaller period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


RUN = "struct<start: long, length: long, period: long>"


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, strongest, collapsed): each text's periodic runs, and the text without their repetitions.

    Words are ``[^\\x20\\x09-\\x0D]+``; ``runs`` come by start and period, positions count
    words from 0, and ``collapsed`` joins the words kept by one blank.
    ``rewrite`` may change a document's words before the search.  A null text
    has no words; every row is a document, repeated ids included; an empty
    table gives no rows.  A text is held as a list of its words by one task.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = [(t or b"").split() for t in batch.column("text").cast(pa.binary()).to_pylist()]  # bytes split at exactly these blanks
            if rewrite is not None:
                texts = [rewrite(i, t) for i, t in zip(ids, texts)]
            found = runs_of(texts)
            best = [strongest(r) for r in found]

            def struct(r):
                return None if r is None else dict(zip(("start", "length", "period"), r))

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([[struct(r) for r in runs] for runs in found], pa.list_(run)),
                    pa.array([struct(r) for r in best], run),
                    pa.array([b" ".join(kept(t, r)) for t, r in zip(texts, found)], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "runs", "strongest", "collapsed"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(work, f"doc_id long, runs array<{RUN}>, strongest {RUN}, collapsed string")
