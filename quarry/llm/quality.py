"""Quality classifier (operator 5): supervised subword embeddings.

A document is the mean of learned vectors of its hashed words, adjacent word
pairs and character n-grams; a softmax over the mean gives the label.  The
vectors and the output layer are trained together by plain stochastic
gradient descent in numpy on a bounded sample of labelled rows.  As the output
is linear in the mean, a bucket's vector acts on a score only by its
projection on the output direction, so scoring reads one number per feature.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import hashing
from quarry.llm.common import id_text, slices, texts_of
from quarry.llm.labels import held_out, label_counts, training_rows


@dataclass(frozen=True)
class Params:
    """Production parameters; ``rows_per_label`` bounds the labelled rows learned from."""

    bits: int = 16
    dim: int = 12
    ngrams: tuple[int, ...] = (3, 5)
    epochs: int = 8
    rate: float = 0.5
    rows_per_label: int = 1500
    seed: int = 17


def features(texts: list[str], p: Params) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind of feature: bucket of every occurrence, and the interval of each text's occurrences.

    Kinds: words, adjacent word pairs (as the difference of the two hashes, so
    any repeated word falls in one bucket) and character n-grams.
    """
    c = hashing.chars(texts)
    w = hashing.words(c)
    shift = hashing.U(64 - p.bits)
    kinds = [(w.hash >> shift, w.first, w.last)]
    pair = hashing.mix((w.hash[1:] - w.hash[:-1]) + hashing.U(p.seed)) >> shift
    kinds.append((pair, w.first, np.maximum(w.first, w.last - 1)))
    for n in p.ngrams:
        kinds.append((hashing.mix(c.ngrams(n) + hashing.U(n)) >> shift, c.first, np.maximum(c.first, c.last - n + 1)))
    return kinds


def bags(texts: list[str], p: Params) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and their shares of its occurrences."""
    kinds, out = features(texts, p), []
    for i in range(len(texts)):
        every = np.concatenate([f[a[i] : b[i]] for f, a, b in kinds])
        ids, counts = np.unique(every.astype(np.int32), return_counts=True)
        out.append((ids, (counts / max(1, len(every))).astype(np.float32)))
    return out


@dataclass
class Model:
    """What scoring needs: one number per bucket and the bias."""

    weight: np.ndarray
    bias: float

    def score(self, texts: list[str], p: Params) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, first, stop in features(texts, p):
            total += hashing.per_text(self.weight[buckets].astype(np.float64), first, stop)
            count += stop - first
        logit = np.clip(self.bias + total / np.maximum(count, 1), -30, 30)
        return 1 / (1 + np.exp(-logit))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], p: Params) -> Model:
    """Stochastic gradient descent over (label, buckets, shares) rows; one class or none gives the base rate."""
    labels = np.array([r[0] for r in rows])
    positive, negative = int((labels == 1).sum()), int((labels != 1).sum())
    prior = math.log((positive + 0.5) / (negative + 0.5)) if len(rows) else 0.0
    buckets = 1 << p.bits
    if not positive or not negative:
        return Model(np.zeros(buckets, np.float32), prior)
    rng = np.random.default_rng(p.seed)
    vectors = rng.uniform(-1 / p.dim, 1 / p.dim, (buckets, p.dim)).astype(np.float32)
    output = np.zeros((2, p.dim), np.float32)
    bias = np.array([0.0, prior], np.float32)
    steps, done = p.epochs * len(rows), 0
    for _ in range(p.epochs):
        for i in rng.permutation(len(rows)):
            label, ids, share = rows[i]
            rate = p.rate * (1 - done / steps)
            done += 1
            if not len(ids):
                continue
            hidden = share @ vectors[ids]
            z = output @ hidden + bias
            e = np.exp(z - z.max())
            error = e / e.sum()
            error[1 if label == 1 else 0] -= 1
            back = error @ output
            output -= rate * np.outer(error, hidden)
            bias -= rate * 0.1 * error
            # shares are tiny; scaling by their norm keeps one step's effect alike for short and long texts
            vectors[ids] -= np.outer(share * (rate / float(share @ share)), back).astype(np.float32) * 0.5
    return Model(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


BAG_DDL = "label int, ids binary, shares binary"


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> Model:
    """Train on at most ``params.rows_per_label`` labelled rows of each label outside the held-out fold.

    The bias is moved from the sample's odds of label 1 to those of all
    training rows, so that scores do not depend on where the sample was cut.
    """

    def to_bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = bags(texts_of(batch), params)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([a.tobytes() for a, _ in made], pa.binary()), pa.array([b.tobytes() for _, b in made], pa.binary())], ["label", "ids", "shares"])

    sample = training_rows(docs, labels, label, {0: params.rows_per_label, 1: params.rows_per_label}, id_col, text_col)
    rows = sample.mapInArrow(to_bags, BAG_DDL).toArrow()
    parsed = [(r["label"], np.frombuffer(r["ids"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows.to_pylist()]
    parsed.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))  # the same model whatever the order of arrival
    model = train(parsed, params)
    one, other = label_counts(labels, label, id_col)
    drawn = sum(r[0] == 1 for r in parsed)
    model.bias += math.log((one + 0.5) / (other + 0.5)) - math.log((drawn + 0.5) / (len(parsed) - drawn + 0.5))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, params: Params = Params()) -> DataFrame:
    """doc_id, held_out, score of label 1, predicted, for every whole text.

    Null and empty texts get the score of no features (the bias); repeated
    rows score alike; a null id stays null and counts as not held out.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 4 bytes for each of 2^bits buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(texts_of(batch), params))], ["doc_id", "score"])

    scored = id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, params: Params = Params()) -> DataFrame:
    """``fit`` and ``score`` in one call."""
    return score(docs, fit(docs, labels, label, params=params), threshold=threshold, params=params)
