"""Vectorised hashes of words and n-grams over a batch of texts (numpy, wrapping 64-bit arithmetic).

A batch is one array of code points; a polynomial prefix sum makes the hash
of any interval two look-ups, so words, word n-grams and character n-grams
cost a few array passes whatever their length.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.full(size, b, U)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=U))
        return self.up, self.down


_CHARS, _WORDS = Powers(0x9E3779B97F4A7C15), Powers(0xD1B54A32D192ED03)


@functools.lru_cache(maxsize=1)
def _char_values() -> np.ndarray:
    return mix(np.arange(1, 0x10001, dtype=U) * U(0x9E3779B97F4A7C15))


@dataclass
class Chars:
    """Code points of a batch; text i is ``codes[first[i]:last[i]]``, one newline after each."""

    codes: np.ndarray
    first: np.ndarray
    last: np.ndarray
    _prefix: np.ndarray | None = None

    @property
    def prefix(self) -> np.ndarray:
        if self._prefix is None:
            n = len(self.codes)
            if n and int(self.codes.max()) >= 0x10000:
                values = np.where(self.codes < 0x10000, _char_values()[np.minimum(self.codes, 0xFFFF)], mix(self.codes.astype(U)))
            else:
                values = _char_values()[self.codes]
            self._prefix = np.zeros(n + 1, U)
            np.cumsum(values * _CHARS.get(n + 1)[0][:n], out=self._prefix[1:], dtype=U)
        return self._prefix

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each interval of code points."""
        p = self.prefix
        return mix((p[end] - p[start]) * _CHARS.get(len(p))[1][start])

    def ngrams(self, n: int) -> np.ndarray:
        """Hash of the n code points from each position on (the last n - 1 positions have none)."""
        p = self.prefix
        m = max(0, len(p) - n)
        return mix((p[n:] - p[:m]) * _CHARS.get(len(p))[1][:m])


def chars(texts: list[str], lower_ascii: bool = False) -> Chars:
    codes = np.frombuffer("".join([t + "\n" for t in texts]).encode("utf-32-le", "surrogatepass"), "<u4")
    if lower_ascii:
        codes = codes + (((codes >= 65) & (codes <= 90)).astype(np.uint32) << 5)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    last = np.cumsum(lengths + 1) - 1
    return Chars(codes, last - lengths, last)


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a batch: code point intervals, text number and hash of each.

    Text i has the words ``first[i]:last[i]``.
    """

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def windows(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(index of first word, hash) of every run of ``k`` words of one text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, U)
        up, down = _WORDS.get(n + 1)
        p = np.zeros(n + 1, U)
        h = mix(self.hash ^ U(salt)) if salt else self.hash
        np.cumsum(h * up[:n], out=p[1:], dtype=U)
        text = np.repeat(np.arange(len(self.first)), self.last - self.first)
        at = np.flatnonzero(text[: n - k + 1] == text[k - 1 :])
        return at, mix((p[at + k] - p[at]) * down[at])


def words(c: Chars, gap: np.ndarray | None = None) -> Words:
    """The words of a batch; ``gap`` marks the code points between them (blanks, unless given; newlines are gaps)."""
    if gap is None:
        gap = (c.codes == 32) | ((c.codes >= 9) & (c.codes <= 13))
    edge = np.flatnonzero(np.diff(gap, prepend=True))  # every text ends in a newline, so edges pair up
    start, end = edge[0::2], edge[1::2]
    return Words(start, end, c.hashes(start, end), np.searchsorted(start, c.first), np.searchsorted(start, c.last))


def per_text(values: np.ndarray, first: np.ndarray, stop: np.ndarray, reduce=np.add, empty: float = 0.0) -> np.ndarray:
    """``reduce`` of ``values[first[i]:stop[i]]`` for each text; ``empty`` where there is none."""
    out = np.full(len(first), empty, np.float64)
    some = stop > first
    if some.any():
        bounds = np.stack([first[some], stop[some]], 1).ravel()
        held = np.append(values, values[:1])  # a last bound may equal the length
        out[some] = reduce.reduceat(held, bounds)[::2]
    return out
