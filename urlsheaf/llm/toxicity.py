"""Toxicity: a factorization machine over hashed terms.

A document's terms are its words in lower case and their beginnings of four to six letters, each hashed to 32 bits;
inflected forms of a stem thus share terms.  Terms are chosen by z tests on document frequencies: those that mark toxic
documents by themselves, and those of pairs that do when they meet or stand alone, even where neither does by itself.
The machine has a weight for each, and a short vector: the product of two vectors is the weight of their meeting in one
document, so that an insult next to the mention of a group can count for more than both.
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
from urlsheaf.llm.quality import fold, labelled_sample

#: Most labelled rows that the model is fitted on: it bounds what one task and the driver see.
SAMPLE = 10_000
FACTORS = 8
EPOCHS = 12
BEGINNINGS = (4, 5, 6)
#: Least documents of a chosen term, least z.
LEAST_DOCS, LEAST_Z = 3, 3.5
#: Terms, the most frequent ones, of which every two are tested together, and the z that asks for: there are many pairs.
PAIRED, PAIR_Z, PAIR_SHARE = 512, 6.0, 0.02
CACHE = 200_000
WORDS = re.compile(r"\w+")


def terms(word: str) -> list[int]:
    """Hashes of the word and of its beginnings."""
    low = word.lower()
    begun = [f"{low[:k]}*" for k in BEGINNINGS if len(low) >= k]
    return [zlib.crc32(t.encode("utf-8", "replace")) for t in (low, *begun)]


@dataclass
class Model:
    """``index`` numbers the chosen terms; ``weights`` and ``vectors`` are by number."""

    bias: float
    index: dict[int, int]
    weights: np.ndarray
    vectors: np.ndarray

    def linear(self, found: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum of weights and of pairwise products of the terms ``found``; the sum of their vectors."""
        v = self.vectors[found]
        total = v.sum(axis=0)
        return self.bias + float(self.weights[found].sum() + 0.5 * (total @ total - (v * v).sum())), total


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


class _Known(dict):
    """word: numbers of its terms that the model has, as 32-bit bytes."""

    def __init__(self, index: dict[int, int]) -> None:
        super().__init__()
        self.index = index

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        found = [self.index[t] for t in terms(word) if t in self.index]
        made = self[word] = np.array(found, np.int32).tobytes()
        return made


def paired_terms(rows: list[tuple[np.ndarray, int]], found: np.ndarray) -> np.ndarray:
    """Those of the terms ``found`` that tell toxic documents only together with another: where both or neither stand,
    toxic documents are more or less frequent than the two terms' own shares let expect."""
    place = {int(t): k for k, t in enumerate(found)}
    x = np.zeros((len(rows), len(found)), np.float32)
    for k, (own, _) in enumerate(rows):
        x[k, [place[t] for t in own.tolist() if t in place]] = 1
    y = np.array([label for _, label in rows], np.float32)
    share = x.mean(axis=0)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    x = (x - share) / spread
    # three-way moment of two terms and the label, of variance one over the rows where nothing depends on anything
    met = (x * ((y - y.mean()) / max(1e-6, y.std()))[:, None]).T @ x / math.sqrt(len(rows))
    np.fill_diagonal(met, 0)
    return found[(np.abs(met) >= PAIR_Z).any(axis=0)]


def choose_terms(rows: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Hashes of the terms that differ between the labels, by themselves or in pairs."""
    toxic = [t for t, label in rows if label]
    clean = [t for t, label in rows if not label]
    if not toxic or not clean:
        return np.empty(0, np.uint32)
    found, a = np.unique(np.concatenate(toxic), return_counts=True)
    other, counts = np.unique(np.concatenate(clean), return_counts=True)
    at = np.minimum(np.searchsorted(other, found), max(0, other.size - 1))
    b = np.where(other[at] == found, counts[at], 0) if other.size else np.zeros_like(a)
    share = (a + b) / len(rows)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / len(toxic) + 1 / len(clean)))
    z = (a / len(toxic) - b / len(clean)) / spread
    alone = found[(a + b >= LEAST_DOCS) & (z >= LEAST_Z)]
    every, counts = np.unique(np.concatenate([t for t, _ in rows]), return_counts=True)
    # frequent, but not so much that nearly all documents agree
    useful = np.flatnonzero((counts >= PAIR_SHARE * len(rows)) & (counts <= (1 - PAIR_SHARE) * len(rows)))
    frequent = every[useful[np.argsort(-counts[useful], kind="stable")[:PAIRED]]]
    return np.union1d(alone, paired_terms(rows, frequent)) if frequent.size else alone


def fit(rows: list[tuple[np.ndarray, int]], rate: float = 0.2, decay: float = 1e-4) -> Model:
    """AdaGrad passes over ``rows`` (term hashes, label); rows of equal terms count once."""
    rows = list({(t.tobytes(), label): (t, label) for t, label in rows}.values())
    chosen = choose_terms(rows)
    index = {int(t): k for k, t in enumerate(chosen)}
    random = np.random.default_rng(1)
    model = Model(0.0, index, np.zeros(len(chosen)), random.normal(0, 0.02, (len(chosen), FACTORS)))
    coded = [(np.array([index[t] for t in found.tolist() if t in index], np.int64), label) for found, label in rows]
    squares, vector_squares, bias_square = np.ones(len(chosen)), np.ones((len(chosen), FACTORS)), 1.0
    for _ in range(EPOCHS):
        for k in random.permutation(len(coded)).tolist():
            found, label = coded[k]
            x, total = model.linear(found)
            g = logistic(x) - label
            bias_square += g * g
            model.bias -= rate * g / math.sqrt(bias_square)
            if found.size:
                v = model.vectors[found]
                gw = g + decay * model.weights[found]
                gv = g * (total - v) + decay * v
                squares[found] += gw * gw
                vector_squares[found] += gv * gv
                model.weights[found] -= rate * gw / np.sqrt(squares[found])
                model.vectors[found] -= rate * gv / np.sqrt(vector_squares[found])
    return model


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        found = [sorted({t for w in set(WORDS.findall(text)) for t in terms(w)}) for text in texts]
        yield pa.RecordBatch.from_arrays(
            [part.column("h"), part.column("label"), pa.array(found, pa.list_(pa.int64()))], ["h", "label", "terms"]
        )


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        found = batch.column("terms")
        for k, label in enumerate(batch.column("label").to_pylist()):
            rows.append((found[k].values.to_numpy().astype(np.uint32), label))
    model = fit(rows)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([*model.index, -1], pa.int64()),
            pa.array([*model.weights, model.bias], pa.float64()),
            pa.array([*model.vectors.tolist(), []], pa.list_(pa.float64())),
        ],
        ["term", "weight", "vector"],
    )


def train(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, limit: int = SAMPLE) -> Model:
    """The model, fitted in one task on at most ``limit`` documents' terms; the driver gets a row for
    each term that was chosen, which the sample bounds."""
    sample = labelled_sample(docs, labels, label, may_learn, limit)
    coded = sample.mapInArrow(_encoded, "h long, label int, terms array<long>")
    ordered = coded.repartition(1).sortWithinPartitions("h", "terms")
    rows = ordered.mapInArrow(_trained, "term long, weight double, vector array<double>").collect()
    bias = next((r.weight for r in rows if r.term < 0), 0.0)
    own = [r for r in rows if r.term >= 0]
    vectors = np.array([r.vector for r in own]).reshape(len(own), FACTORS)
    return Model(bias, {r.term: k for k, r in enumerate(own)}, np.array([r.weight for r in own]), vectors)


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = SAMPLE) -> DataFrame:
    """``(doc_id, held_out, score)`` of every row of ``docs``.

    Rows whose ``crc32(doc_id) mod 3`` is 1 are held out of training.  A null text counts as empty, and a text without
    any known term scores the bias alone.  A row without id is scored and not held out; repeated rows have equal
    scores.  Labels that are null teach nothing; without both kinds of label no term is chosen, and without any label
    all scores are one half.  Other columns are ignored.  No documents: no rows.
    """
    model = train(docs, labels, label, ~fold(3, 1), limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(model.index)
        for part, texts in text_slices(batches):
            scores = []
            for text in texts:
                found = np.frombuffer(b"".join(map(known.__getitem__, WORDS.findall(text))), np.int32)
                scores.append(logistic(model.linear(np.unique(found))[0]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    scored = small_batches(docs).select("doc_id", "text").mapInArrow(run, schema)
    return scored.select("doc_id", F.coalesce(fold(3, 1), F.lit(False)).alias("held_out"), "score")
