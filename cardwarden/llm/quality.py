"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

An n-gram is one word or two in a row, of the words themselves and of their shapes (runs
of capitals, small letters, digits and each sign; the same word again is a shape of its
own). N-grams are hashed to ``1 << BITS`` weights. Training visits a bounded sample of
labelled documents one by one, so it is one task of fixed size; scores are sparse dot
products in one pass over all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm import words as W

BITS = 20
#: Sum of a document's feature values, whatever its length.
MASS = 32.0


@dataclass(frozen=True)
class Training:
    """``sample``: most labelled documents that are read for the fit."""

    sample: int = 8192
    epochs: int = 2
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 1e-4


_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("x")
_SHAPE[0x80:] = ord("x")
_SHAPE[ord("A") : ord("Z") + 1] = ord("X")
_SHAPE[ord("0") : ord("9") + 1] = ord("9")
_VALUE = W.randoms(256, 11)
_KIND = W.randoms(4, 12)
_AGAIN = W.randoms(1, 13)[0]


def _shapes(w: W.Words) -> np.ndarray:
    """A hash of each word's runs of letter kinds and signs."""
    n = len(w.bytes)
    shape = _SHAPE[w.bytes]
    begins = np.zeros(n, bool)
    begins[w.start] = True
    run = begins.copy()
    run[1:] |= shape[1:] != shape[:-1]
    run &= ~W.SPACE[w.bytes]
    count = np.cumsum(run)
    head = w.start[0]
    place = count[head:] - np.repeat(count[w.start], np.diff(w.start, append=n))
    weight = W.places(int(place.max()) + 1)
    value = np.where(run[head:], _VALUE[shape[head:]] * weight[np.maximum(place, 0)], np.uint64(0))
    hashed = W.mix(np.add.reduceat(value, w.start - head))
    again = np.zeros(len(hashed), bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    hashed[again] = _AGAIN
    return hashed


def features(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and weight number of every n-gram, repeats included, in order of texts."""
    if not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    docs, values = [], []
    pair = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    for i, h in enumerate((w.hash, _shapes(w))):
        docs += [w.doc, w.doc[pair]]
        values += [h * _KIND[2 * i], (h[pair] * np.uint64(3) + h[pair + 1]) * _KIND[2 * i + 1]]
    doc = np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    number = (W.mix(np.concatenate(values)) >> np.uint64(64 - BITS)).astype(np.int64)
    return doc[order], number[order]


def _ftrl(examples: list[tuple[int, np.ndarray, np.ndarray]], how: Training) -> tuple[np.ndarray, float]:
    """Weights and bias after one visit to each example in each epoch."""
    z, squares = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_squares = 0.0

    def weights(z, squares):
        rate = (how.beta + np.sqrt(squares)) / how.alpha + how.l2
        return -np.sign(z) * np.maximum(np.abs(z) - how.l1, 0.0) / rate

    for _ in range(how.epochs):
        for label, at, value in examples:
            w = weights(z[at], squares[at])
            bias = -bias_z * how.alpha / (how.beta + bias_squares**0.5)
            p = 1 / (1 + np.exp(-np.clip(w @ value + bias, -30, 30)))
            slope = (p - label) * value
            more = squares[at] + slope * slope
            z[at] += slope - (np.sqrt(more) - np.sqrt(squares[at])) / how.alpha * w
            squares[at] = more
            grown = bias_squares + (p - label) ** 2
            bias_z += (p - label) - (grown**0.5 - bias_squares**0.5) / how.alpha * bias
            bias_squares = grown
    return weights(z, squares), -bias_z * how.alpha / (how.beta + bias_squares**0.5)


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """A model of ``labels`` (doc_id, label) over ``docs`` (doc_id, text).

    Of the labelled rows, the ``how.sample`` smallest by a hash of the id are used; that
    many ids are broadcast, so texts are not shuffled. Null labels and ids are no
    examples. Without examples every score is one half.
    """
    order = F.xxhash64("doc_id")
    used = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    used = used.select("doc_id", F.col("label").cast("int").alias("label"), order.alias("order"))
    used = used.orderBy("order", "doc_id", "label").limit(how.sample)
    examples = docs.join(F.broadcast(used), "doc_id").select("order", "doc_id", "label", "text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for batch in batches:
            labels = batch.column(2).to_numpy()
            for w in W.slices(batch.column(3), lower=False):
                doc, number = features(w)
                edge = np.searchsorted(doc, np.arange(w.last - w.first + 1))
                for i in range(w.last - w.first):
                    own = number[edge[i] : edge[i + 1]]
                    at, count = np.unique(own, return_counts=True)
                    value = count * (MASS / max(1, len(own)))
                    seen.append((int(labels[w.first + i]), at.astype(np.int32), value))
        if seen:
            weights, bias = _ftrl(seen, how)
            packed = zlib.compress(weights.astype(np.float32).tobytes(), 1)
            columns = [pa.array([packed], pa.binary()), pa.array([float(bias)])]
            yield pa.RecordBatch.from_arrays(columns, names=["weights", "bias"])

    one = examples.repartition(1).sortWithinPartitions("order", "doc_id", "label", "text")
    found = one.mapInArrow(train, "weights binary, bias double").collect()
    if not found:
        return Model(np.zeros(1 << BITS, np.float32), 0.0)
    weights = np.frombuffer(zlib.decompress(bytes(found[0].weights)), np.float32)
    return Model(weights, found[0].bias)


def score(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and the score of every whole text, 0 to 1. Null and empty get the bias's."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            found = []
            for w in W.slices(batch.column(len(keys))):
                doc, number = features(w)
                size = w.last - w.first
                total = np.bincount(doc, weights=weights[number], minlength=size)
                found.append(total * MASS / np.maximum(1, np.bincount(doc, minlength=size)))
            margin = np.concatenate([*found, np.zeros(0)]) + bias
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            columns = [*batch.columns[: len(keys)], pa.array(p)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "score"])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keys)
    return docs.select(*keys, text).mapInArrow(run, f"{kept}, score double")


def held_out(doc_id: Column) -> Column:
    """One fifth of the ids, by a checksum; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
