"""Toxicity (operator 6): noisy-channel deobfuscation, then scores of the restored text.

* A character trigram model is counted over every text of the corpus, each
  text between boundaries of its own.
* Disguised stretches (words that mix letters and look-alike signs, three or
  more characters spaced out, letters repeated) become a lattice: a sign may stand for itself or for the
  letters it resembles, a gap between single letters may be there or not, a
  run of one letter may stand for one or two.  Viterbi decoding under the
  trigram model picks the reading; all other text is its own only reading.
* Evidence: words of the restored text and their beginnings, weighted by
  their log-odds over a bounded sample of labelled rows.  A text is judged by
  its eight strongest, whatever its length; a logistic link fitted on rows
  that the weights did not see makes it a probability.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import hashing
from quarry.llm.common import id_text, slices, texts_of
from quarry.llm.labels import held_out, label_counts, training_rows

# Signs and the letters they stand for.
LEET = {"@": "a", "4": "a", "3": "e", "1": "il", "!": "i", "|": "il", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t", "8": "b", "9": "g", "6": "g", "2": "z"}
# The letters the model tells apart; all signs of LEET are one more symbol, 0 is everything else (a word boundary).
ALPHABET = "abcdefghijklmnopqrstuvwxyzäöüßàâæçéèêëîïôœùûáíóúñ"
SIGN = len(ALPHABET) + 1
SIZE = len(ALPHABET) + 2


@dataclass(frozen=True)
class Params:
    """Production parameters; ``toxic_rows`` and ``clean_rows`` bound the labelled rows learned from."""

    prefixes: tuple[int, ...] = (4, 5, 6, 7, 8)
    bits: int = 21
    toxic_rows: int = 3000
    clean_rows: int = 6000
    least_rows: int = 4
    least_gain: float = 12.0
    seed: int = 23


# ------------------------------------------------------- character language model


@functools.lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Code point (below 0x10000) -> letter number."""
    table = np.zeros(0x10000, np.int64)
    for i, letter in enumerate(ALPHABET, 1):
        for form in {letter, letter.upper()}:
            if len(form) == 1:
                table[ord(form)] = i
    table[[ord(c) for c in LEET]] = SIGN
    return table


def letter_numbers(codes: np.ndarray) -> np.ndarray:
    return _codes()[np.minimum(codes, 0xFFFF)]


def bounded(c: hashing.Chars) -> np.ndarray:
    """Letter numbers of a batch with two boundaries before each text and two after, shared by neighbours: no trigram holds letters of two texts."""
    return np.concatenate([[0], np.insert(letter_numbers(c.codes), c.first, 0), [0]])


def trigram_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all texts: ``SIZE``^3 numbers, whatever the corpus.

    Every task adds up its own texts first and sends one row per first letter.
    The counts do not depend on how texts are dealt to batches.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in slices(batches):
            x = bounded(hashing.chars(texts_of(batch)))
            total += np.bincount((x[:-2] * SIZE + x[1:-1]) * SIZE + x[2:], minlength=SIZE**3)
        rows = total.reshape(SIZE, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(SIZE), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], ["letter", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in table.column("counts").to_pylist())
        return pa.table({"letter": table.column("letter")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    ddl = "letter int, counts binary"
    parts = id_text(docs, id_col, text_col).mapInArrow(count, ddl).groupBy("letter").applyInArrow(add, ddl)
    out = np.zeros((SIZE, SIZE * SIZE), np.int64)
    for r in parts.collect():  # SIZE rows
        out[r["letter"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(SIZE, SIZE, SIZE)


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), interpolated with the bigram and letter models."""
    tri, bi, uni = counts + 0.0, counts.sum(0) + 0.0, counts.sum((0, 1)) + 1.0
    uni /= uni.sum()
    bi = (bi + 5 * uni) / (bi.sum(1, keepdims=True) + 5)
    tri = (tri + 5 * bi[None]) / (tri.sum(2, keepdims=True) + 5)
    return np.log(tri)


# ----------------------------------------------------------------- noisy channel

_NUMBER = {c: i for i, c in enumerate(ALPHABET, 1)} | dict.fromkeys(LEET, SIGN)
_SIGNS = "".join(LEET)
_LETTER = r"[^\W\d_]"
_ONE = rf"(?:{_LETTER}|[{re.escape(_SIGNS)}])"
_SPACED = re.compile(rf"(?<!\w){_ONE}([ ._*\-]){_ONE}(?:\1{_ONE})+(?!\w)")
_SIGNS_IN_SETS = re.escape(_SIGNS)
_OTHER_SIGNS = re.escape("".join(c for c in LEET if not c.isdigit()))
_MIXED = re.compile(rf"{_LETTER}[{_SIGNS_IN_SETS}]|[{_SIGNS_IN_SETS}]{_LETTER}|[{_OTHER_SIGNS}][0-9]|[0-9][{_OTHER_SIGNS}]")
# signs inside a word or at its beginning: what only a disguise has
_INSIDE = re.compile(rf"{_LETTER}[{_SIGNS_IN_SETS}]+(?={_LETTER})|(?<![\w{_SIGNS_IN_SETS}])[{_SIGNS_IN_SETS}]{{1,2}}(?={_LETTER}{{2}})")
_REPEAT = re.compile(rf"({_LETTER})\1\1+", re.I)
_GAPS = " ._*-"
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*")
_BLANKS = " \t\n\x0b\x0c\r"
_HEAD, _TAIL = "\"'([{<*_", "\"')]}>*_.,;:?!"

# Costs of the channel, as log probabilities.
_AS_SIGN, _AS_LETTER, _DROP, _KEEP = math.log(0.4), math.log(0.3), math.log(0.95), math.log(0.05)
# A code (a key, a number, an address) instead of a disguised word: that it is one, and each of its characters.
_IS_CODE, _CODE = -3.0, -math.log(40)


class Decoder:
    """Viterbi decoding of one disguised stretch under the trigram model."""

    def __init__(self, log_probs: np.ndarray):
        self.logp = log_probs.tolist()
        self.memo: dict[str, str] = {}

    def arcs(self, piece: str) -> list[list[tuple[str, float]]]:
        """The lattice: for each place its readings (perhaps empty) and their costs."""
        out, i, low = [], 0, piece.lower()
        while i < len(low):
            c, end = low[i], i + 1
            if c in ALPHABET:
                while end < len(low) and low[end] == c:
                    end += 1
                n = end - i
                out.append([(c, 0.0)] if n == 1 else [(c * 2, 0.0), (c, -2.0)] if n == 2 else [(c, -0.5), (c * 2, -0.5)])
            elif c in LEET:
                out.append([(c, _AS_SIGN), *((x, _AS_LETTER) for x in LEET[c])])
            elif c in _GAPS and 0 < i < len(low) - 1 and all(j < 0 or j >= len(low) or low[j] in _GAPS for j in (i - 2, i + 2)):
                out.append([("", _DROP), (c, _KEEP)])  # between two single characters
            else:
                out.append([(c, 0.0)])
            i = end
        return out

    def decode(self, piece: str, word: bool = True) -> str:
        """The likeliest reading; where ``word`` is False, a code of equally likely characters, left as it is, is one of them."""
        if piece in self.memo:
            return self.memo[piece]
        logp, number = self.logp, _NUMBER
        scores, steps = {(0, 0): 0.0}, []  # best score of each pair of last letters; how each was reached
        for readings in [*self.arcs(piece), [(" ", 0.0)]]:
            new: dict[tuple[int, int], float] = {}
            back: dict[tuple[int, int], tuple[tuple[int, int], str]] = {}
            for state, held in scores.items():
                for put, cost in readings:
                    (x, y), score = state, held + cost
                    for c in put:
                        z = number.get(c, 0)
                        score += logp[x][y][z]
                        x, y = y, z
                    if score > new.get((x, y), -math.inf):
                        new[x, y], back[x, y] = score, (state, put)
            scores = new
            steps.append(back)
        last = state = max(scores, key=lambda s: (scores[s], s))
        read = []
        for back in reversed(steps):
            state, put = back[state]
            read.append(put)
        best = "".join(reversed(read))[:-1]
        if not word and scores[last] < _IS_CODE + _CODE * len(piece):
            best = piece
        if len(self.memo) < 100_000:
            self.memo[piece] = best
        return best

    def restore(self, text: str) -> str:
        """The whole text with every disguised stretch replaced by its likeliest reading."""
        text = _SPACED.sub(lambda m: self.decode(m.group()), text)
        spots = sorted({m.start() for p in (_MIXED, _REPEAT) for m in p.finditer(text)})
        parts, last = [], 0
        for spot in spots:
            if spot < last:
                continue
            start = 1 + max(text.rfind(c, last, spot) for c in _BLANKS)
            start = max(start, last)
            end = _TOKEN.match(text, spot).end()
            token = text[start:end]
            head = len(token) - len(token.lstrip(_HEAD))
            tail = len(token.rstrip(_TAIL)) if head < len(token) else len(token)
            mixed = _MIXED.search(token, head, tail) is not None
            if mixed or _REPEAT.search(token, head, tail):  # not punctuation alone
                word = not mixed or _INSIDE.search(token, head, tail) is not None
                parts += (text[last : start + head], self.decode(token[head:tail], word), token[tail:])
                last = end
        return "".join([*parts, text[last:]])


def disguised(c: hashing.Chars) -> np.ndarray:
    """Which texts of a batch may hold a disguised stretch (a superset, found by array passes)."""
    codes = c.codes
    hits = np.zeros(len(codes), bool)
    number = letter_numbers(codes)
    sign = number == SIGN
    letter = (number > 0) & ~sign
    digit = (codes >= 48) & (codes <= 57)
    same = (codes[1:] | 32) == (codes[:-1] | 32)
    hits[:-2] |= letter[:-2] & same[:-1] & same[1:]
    before, after = sign[:-1] & (letter[1:] | (digit[1:] & ~digit[:-1])), sign[1:] & (letter[:-1] | (digit[:-1] & ~digit[1:]))
    hits[:-1] |= before | after
    gap = _gap_table()[np.minimum(codes, 0xFFFF)]
    one = letter | sign
    hits[:-4] |= one[:-4] & gap[1:-3] & one[2:-2] & gap[3:-1] & one[4:]
    total = np.concatenate([[0], np.cumsum(hits)])
    return total[c.last] > total[c.first]


@functools.lru_cache(maxsize=1)
def _gap_table() -> np.ndarray:
    table = np.zeros(0x10000, bool)
    table[[ord(s) for s in _GAPS]] = True
    return table


def restored(texts: list[str], decoder: Decoder) -> list[str]:
    """Lower-cased texts without disguises."""
    odd = disguised(hashing.chars(texts))
    return [(decoder.restore(t) if o else t).lower() for t, o in zip(texts, odd)]


# ------------------------------------------------------------------- scoring

# Near copies among the rows learned from: Jaccard similarity of their buckets, and the search for candidates.
_NEAR, _PROPOSE, _BINS = 0.8, 0.65, 128


def buckets(texts: list[str], p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every word and word beginning, kind by kind; words are runs of letters."""
    c = hashing.chars(texts)
    w = hashing.words(c, ~(((c.codes >= 97) & (c.codes <= 122)) | (c.codes >= 0xC0)))
    text = np.repeat(np.arange(len(texts), dtype=np.int64), w.last - w.first)
    shift, length = hashing.U(64 - p.bits), w.end - w.start
    texts_of_kind, kinds = [text], [hashing.mix(w.hash + hashing.U(p.seed)) >> shift]
    for n in p.prefixes:
        k = np.flatnonzero(length >= n)
        texts_of_kind.append(text[k])
        kinds.append(hashing.mix(c.hashes(w.start[k], w.start[k] + n) + hashing.U(n)) >> shift)
    return np.concatenate(texts_of_kind), np.concatenate(kinds).astype(np.int64)


def distinct(texts: list[str], p: Params) -> list[np.ndarray]:
    """The distinct buckets of each text."""
    text, bucket = buckets(texts, p)
    pairs = np.unique(text << 32 | bucket)
    cuts = np.searchsorted(pairs, np.arange(1, len(texts), dtype=np.int64) << 32)
    return [(x & 0xFFFFFFFF).astype(np.int32) for x in np.split(pairs, cuts)]


def summary(weights_of_text: np.ndarray) -> list[float]:
    """Constant, strongest weight, mean of the second to fourth, mean of the fifth to eighth."""
    x = np.zeros(8)
    top = np.sort(weights_of_text)[::-1][:8]
    x[: len(top)] = top
    return [1.0, float(x[0]), float(x[1:4].mean()), float(x[4:].mean())]


@dataclass
class Model:
    """Trigram model, n-gram weights and the logistic link."""

    log_probs: np.ndarray
    weight: np.ndarray
    link: np.ndarray

    def score(self, texts: list[str], p: Params) -> np.ndarray:
        """Probability of label 1 for each restored text."""
        text, bucket = buckets(texts, p)
        some = self.weight[bucket] > 0
        pairs = np.unique(text[some] << 32 | bucket[some])
        x = np.zeros((len(texts), 4))
        x[:, 0] = 1.0
        owner = pairs >> 32
        for i in np.unique(owner):
            x[i] = summary(self.weight[pairs[owner == i] & 0xFFFFFFFF])
        z = x[:, 0] * self.link[0] + x[:, 1] * self.link[1] + x[:, 2] * self.link[2] + x[:, 3] * self.link[3]  # one order of additions, whatever the batch
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def signature(ids: np.ndarray) -> np.ndarray:
    """Smallest hash of each of ``_BINS`` parts of a set (the largest number where a part is empty): as many min-hashes in one pass."""
    h = hashing.mix(ids.astype(hashing.U))
    out = np.full(_BINS, np.iinfo(hashing.U).max, hashing.U)
    np.minimum.at(out, (h % hashing.U(_BINS)).astype(np.int64), h)
    return out


def single(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The non-empty sets (sorted, distinct) in order, without those of Jaccard similarity ``_NEAR`` or more to one kept before.

    Signatures only propose pairs: those that agree in ``_PROPOSE`` of the parts
    (over four standard deviations below ``_NEAR``).  The sets themselves decide.
    """
    kept: list[np.ndarray] = []
    marks = np.zeros((len(sets), _BINS), hashing.U)
    sizes = np.zeros(len(sets), np.int64)
    empty = np.iinfo(hashing.U).max
    for ids in sets:
        if not len(ids):
            continue
        mark, n = signature(ids), len(kept)
        like = np.flatnonzero((sizes[:n] >= _NEAR * len(ids)) & (sizes[:n] * _NEAR <= len(ids)))
        held = marks[like]
        same = ((held == mark) & (mark != empty)).sum(1)
        some = ((held != empty) | (mark != empty)).sum(1)
        near = False
        for i in like[same >= _PROPOSE * some]:
            common = len(np.intersect1d(kept[i], ids, assume_unique=True))
            near = common >= _NEAR * (len(kept[i]) + len(ids) - common)
            if near:
                break
        if not near:
            marks[n], sizes[n] = mark, len(ids)
            kept.append(ids)
    return kept


def weights(rows: list[tuple[int, np.ndarray]], p: Params) -> np.ndarray:
    """Log-odds of buckets that toxic rows show significantly more often; others weigh nothing.

    Near copies (see ``single``) count once per label.
    """
    size = 1 << p.bits
    seen = [np.zeros(size, np.int32), np.zeros(size, np.int32)]
    rows_of = [0, 0]
    for toxic in (0, 1):
        for ids in single([ids for label, ids in rows if (label == 1) == toxic]):
            seen[toxic][ids] += 1
            rows_of[toxic] += 1
    clean, toxic = rows_of
    out = np.zeros(size, np.float32)
    if not clean or not toxic:
        return out
    at = np.flatnonzero(seen[1] >= p.least_rows)
    t, c = seen[1][at].astype(float), seen[0][at].astype(float)
    expected = (t + c) * toxic / (toxic + clean)
    other = np.maximum((t + c) - expected, 1e-9)
    gain = 2 * (t * np.log(t / expected) + c * np.log(np.maximum(c, 1e-9) / other))
    odds = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
    out[at] = np.where((odds > 0) & (gain >= p.least_gain), odds, 0)
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 200) -> np.ndarray:
    """Ridge logistic regression (first column constant, not penalised) by Newton steps that are halved until the loss falls."""
    penalty = np.diag([0.0] + [ridge] * (x.shape[1] - 1))

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * b @ penalty @ b)

    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (q - y) + penalty @ beta
        step = np.linalg.solve((x.T * (q * (1 - q))) @ x + penalty + 1e-6 * np.eye(len(beta)), slope)
        size, held = 1.0, loss(beta)
        while size > 1e-6 and loss(beta - size * step) > held:
            size /= 2
        beta = beta - size * step
        if size * np.abs(step).max() < 1e-7:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> Model:
    """Count the language model over all texts; learn weights and link from the bounded sample.

    Three quarters of the sample give the weights, the rest the link, whose
    constant is moved from the sample's share of toxic rows to that of all
    training rows.  Without rows of both labels the score is the base rate
    (one half without rows).
    """
    spark = docs.sparkSession
    log_probs = log_model(trigram_counts(docs, id_col, text_col))
    shared = spark.sparkContext.broadcast(log_probs)  # SIZE^3 numbers

    def to_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in slices(batches):
            ids = distinct(restored(texts_of(batch), decoder), params)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([x.tobytes() for x in ids], pa.binary())], ["label", "ids"])

    sample = training_rows(docs, labels, label, {1: params.toxic_rows, 0: params.clean_rows}, id_col, text_col, params.seed)
    rows = [(r["label"], np.frombuffer(r["ids"], np.int32)) for r in sample.mapInArrow(to_buckets, "label int, ids binary").toArrow().to_pylist()]
    # one order, whatever the order of arrival, and one that says nothing about the text
    rows.sort(key=lambda r: (zlib.crc32(r[1].tobytes()), r[0], r[1].tobytes()))
    learn, check = [r for i, r in enumerate(rows) if i % 4], rows[::4]
    model = Model(log_probs, weights(learn, params), np.zeros(4))
    y = np.array([float(r[0] == 1) for r in check])
    toxic, clean = label_counts(labels, label, id_col)
    drawn_toxic = sum(r[0] == 1 for r in rows)
    prior = math.log((toxic + 0.5) / (clean + 0.5))
    if len(y) and 0 < y.sum() < len(y):
        model.link = logistic(np.array([summary(model.weight[r[1]]) for r in check]), y)
        model.link[0] += prior - math.log((drawn_toxic + 0.5) / (len(rows) - drawn_toxic + 0.5))
    else:
        model.link[0] = prior
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, score of label 1, predicted, for every whole text.

    Null and empty texts get the score of no evidence; repeated rows score
    alike; a null id stays null and counts as not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 4 bytes for each of 2^bits buckets, and SIZE^3 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value.log_probs)
        for batch in slices(batches):
            scores = shared.value.score(restored(texts_of(batch), decoder), params)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    scored = id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5, params: Params = Params()) -> DataFrame:
    """``docs`` without the rows whose text scores ``threshold`` or more; columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value.log_probs)
        for batch in slices(batches, text_col):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(shared.value.score(restored(texts, decoder), params) < threshold))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, params: Params = Params()) -> DataFrame:
    """``fit`` and ``score`` in one call."""
    return score(docs, fit(docs, labels, label, params=params), threshold=threshold, params=params)
