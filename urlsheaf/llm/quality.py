"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

Words are runs of letters and digits, or runs of other signs.  A document's features are its words and word pairs in
lower case, and pairs of word forms (capitals, digits, signs, a word said twice), each hashed to one of ``DIM``
weights; their values are logarithms of counts, scaled to length one.  The weights are trained by FTRL-proximal
updates, one pass after the other over a sample of at most ``SAMPLE`` labelled rows.  A score is the sparse dot
product with the weights, sent through the logistic function.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urlsheaf.llm.common import small_batches, text_slices

#: Size of the weight vector, and with it the bound of what is broadcast.
DIM = 1 << 18
#: Most labelled rows that the model is fitted on: those of the smallest hash of their id.
SAMPLE = 10_000
EPOCHS = 10
WORDS = re.compile(r"\w+|[^\w\s]+")
#: Words that a worker keeps the hash of.
CACHE = 200_000


def _form(word: str) -> int:
    if not (word[0].isalnum() or word[0] == "_"):
        return 5 + min(len(word), 3)
    if word.isdigit():
        return 1
    if len(word) > 1 and word.isupper():
        return 2
    return 3 if word[0].isupper() else 4


class _Hashes(dict):
    """word: hash of its lower-case form, its form in the lowest four bits."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        made = self[word] = zlib.crc32(word.lower().encode("utf-8", "replace")) << 4 | _form(word)
        return made


_hashes = _Hashes()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers, ascending, and their values.  A text without words has none."""
    coded = np.fromiter(map(_hashes.__getitem__, WORDS.findall(text)), np.uint64)
    if not coded.size:
        return np.empty(0, np.int64), np.empty(0)
    words, forms = coded >> np.uint64(4), coded & np.uint64(15)
    again = (words[1:] == words[:-1]).astype(np.uint64)
    found = np.concatenate(
        [
            words + np.uint64(1),
            (words[:-1] * _MIX) ^ (words[1:] + np.uint64(3)),
            (forms[:-1] * np.uint64(64) + forms[1:] * np.uint64(2) + again + np.uint64(1 << 40)),
        ]
    )
    found *= _MIX
    index, counts = np.unique((found >> np.uint64(64 - 18)).astype(np.int64), return_counts=True)
    values = np.log1p(counts)
    return index, values / math.sqrt(float(values @ values))


@dataclass(frozen=True)
class Ftrl:
    """Settings of the updates."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.005
    l2: float = 0.001
    epochs: int = EPOCHS

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
        """Weights and bias after all passes over ``rows`` (feature numbers, values, label)."""
        z, n, bias, grown = np.zeros(DIM), np.zeros(DIM), 0.0, 1.0
        for _ in range(self.epochs):
            for index, values, label in rows:
                w = self._weights(z[index], n[index])
                p = 1 / (1 + math.exp(-max(-35.0, min(35.0, float(w @ values) + bias))))
                g = (p - label) * values
                square = g * g
                z[index] += g - (np.sqrt(n[index] + square) - np.sqrt(n[index])) / self.alpha * w
                n[index] += square
                grown += (p - label) ** 2
                bias -= self.alpha * (p - label) / math.sqrt(grown)
        return self._weights(z, n), bias

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(
            np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, limit: int) -> DataFrame:
    """``(h, text, label)`` of at most ``limit`` labelled documents, a label being 1 if most of a document's are.

    ``may_learn`` is a condition on doc_id.  Labels or ids that are null are left out.
    """
    chosen = (
        labels.select("doc_id", F.col(label).alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .where(may_learn)
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .withColumn("h", F.xxhash64("doc_id"))
        .orderBy("h")
        .limit(limit)
    )
    # at most ``limit`` short rows are broadcast
    return small_batches(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("h", "text", "label")


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        made = [features(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("h"),
                part.column("label"),
                pa.array([i.astype(np.int32) for i, _ in made], pa.list_(pa.int32())),
                pa.array([v.astype(np.float32) for _, v in made], pa.list_(pa.float32())),
            ],
            ["h", "label", "index", "value"],
        )


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        offsets = [batch.column(c) for c in ("index", "value")]
        for i, label in enumerate(batch.column("label").to_pylist()):
            rows.append((offsets[0][i].values.to_numpy(), offsets[1][i].values.to_numpy().astype(float), label))
    if rows:
        weights, bias = Ftrl().fit(rows)
        index = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(index, DIM)), pa.array(np.append(weights[index], bias))], ["place", "weight"]
        )


def train(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, limit: int = SAMPLE) -> np.ndarray:
    """Weights, the bias behind them.  One task sees the features of at most ``limit`` documents; the driver gets at
    most ``DIM + 1`` weights.  Without labelled rows all are zero, and every score is one half."""
    sample = labelled_sample(docs, labels, label, may_learn, limit)
    coded = sample.mapInArrow(_encoded, "h long, label int, index array<int>, value array<float>")
    ordered = coded.repartition(1).sortWithinPartitions("h", "index")
    weights = np.zeros(DIM + 1)
    for place, weight in ordered.mapInArrow(_trained, "place long, weight double").collect():
        weights[place] = weight
    return weights


def with_score(docs: DataFrame, weights: np.ndarray, keep: list[str], score: str = "score") -> DataFrame:
    """Columns ``keep`` of ``docs`` and the score of its text."""

    # Arrow batches by plain names, as those of ``docs`` may hold dots
    columns = list(dict.fromkeys([*keep, "text"]))
    plain = [f"c{k}" for k in range(len(columns))]
    text, kept = plain[columns.index("text")], plain[: len(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text):
            scores = []
            for t in texts:
                index, values = features(t)
                linear = float(weights[index] @ values) + weights[DIM]
                scores.append(1 / (1 + math.exp(-max(-35.0, min(35.0, linear)))))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(scores, pa.float64())], [*kept, "score"]
            )

    read = small_batches(docs).select(*(F.col(f"`{c}`") for c in columns)).toDF(*plain)
    schema = T.StructType([*(read.schema[c] for c in kept), T.StructField("score", T.DoubleType())])
    return read.mapInArrow(run, schema).toDF(*keep, score)


def fold(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id, written as text, has that remainder."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score)`` of every row of ``docs``.

    Rows whose ``crc32(doc_id) mod 5`` is 0 are held out of training.  A null text counts as empty; an empty text's
    score is that of the bias.  A row without id is scored and not held out.  Rows are scored one by one, so repeated
    rows have equal scores.  Other columns are ignored.  No documents: no rows.
    """
    weights = train(docs, labels, label, ~fold(5, 0), limit)
    held_out = F.coalesce(fold(5, 0), F.lit(False)).alias("held_out")
    return with_score(docs, weights, ["doc_id"]).select("doc_id", held_out, "score")


def keep_good(docs: DataFrame, labels: DataFrame, least: float, label: str = "quality", limit: int = SAMPLE) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``least`` or more."""
    score = "score"
    while score in docs.columns:
        score += "_"
    weights = train(docs, labels, label, ~fold(5, 0), limit)
    return with_score(docs, weights, docs.columns, score).where(F.col(score) >= least).drop(F.col(f"`{score}`"))
