"""Toxicity by logistic regression over hashed words, word pairs and skip-grams, trained by FTRL-proximal.

Each coordinate has its own learning rate, and an L1 term keeps the weights of rare
features at zero, so the model that is broadcast is a short list of slots and weights.
A text's features are present or absent, however often they occur. Words are
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Training reads a bounded sample of labelled rows outside the held-out fold (SAMPLE_ROWS);
every text is scored whole. A null or empty text has the model's bias alone. Without any
label the score is 0. Rows are scored one by one, so repeated rows and null or repeated ids
are unaffected (a null id is not held out); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.labelled import held_out, training_rows
from tablebridge.llm.words import Words, chunks, mixed, split_words

SLOT_BITS = 20
SKIPS = (1, 2, 3)  # distance of the words of a pair; beyond 1 it is a skip-gram
SAMPLE_ROWS = 8_000
PASSES = 3
TOXIC_WEIGHT = 3  # times that a toxic example is shown in a pass
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.1
THRESHOLD = 0.5


@dataclass(frozen=True)
class Model:
    slots: np.ndarray  # ascending
    weights: np.ndarray
    bias: float



def features(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(texts, slots) of words, then of pairs at each distance."""
    text = np.repeat(np.arange(len(w.first) - 1), w.counts())
    yield text, _slot(mixed(w.hash))
    for skip in SKIPS:
        left, right = w.hash[:-skip], w.hash[skip:]
        inside = text[:-skip] == text[skip:]
        yield text[:-skip][inside], _slot(mixed((left * np.uint64(0x100000001B3) + right + np.uint64(skip))[inside]))


def _slot(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _present(texts: pa.Array, live: np.ndarray | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from text, to text, texts, distinct slots); only slots in ``live`` if given."""
    for a, b, data, offsets in chunks(texts):
        both = []
        for text, slots in features(split_words(data, offsets)):
            kept = slice(None) if live is None else live[slots]
            both.append(text[kept] << SLOT_BITS | slots[kept])
        pairs = np.unique(np.concatenate(both))
        yield a, b, pairs >> SLOT_BITS, pairs & (1 << SLOT_BITS) - 1


def hashed(rows: DataFrame) -> DataFrame:
    """y and the slots of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, text, slots in _present(batch.column("text")):
                edges = np.searchsorted(text, np.arange(b - a + 1))
                yield pa.RecordBatch.from_pydict({
                    "y": batch.column("y").slice(a, b - a), "slots": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(slots, pa.int32()))})

    return rows.select("text", F.col("y").cast("int").alias("y")).mapInArrow(run, "y int, slots array<int>")


def fit(examples: list[tuple[int, np.ndarray]], passes: int = PASSES, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> Model:
    """FTRL-proximal over (label, slots) in the given order, again and again."""
    size = (1 << SLOT_BITS) + 1  # the last slot is the bias, which is not shrunk
    z, n = np.zeros(size), np.zeros(size)

    def weight(at: np.ndarray) -> np.ndarray:
        strict = np.where(at == size - 1, 0.0, l1)
        return np.where(np.abs(z[at]) <= strict, 0.0, (np.sign(z[at]) * strict - z[at]) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(passes):
        for y, slots in (e for e in examples for _ in range(TOXIC_WEIGHT if e[0] else 1)):
            at = np.append(slots, size - 1)
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    final = weight(np.arange(size))
    slots = np.flatnonzero(final[:-1])
    return Model(slots, final[slots].astype(np.float32), float(final[-1]))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """The model of a bounded sample, in an order that does not depend on the tasks; None without labels."""
    rows = hashed(training_rows(docs, labels, "toxic", sample_rows)).toLocalIterator()
    examples = [(r.y, np.array(r.slots, dtype=np.int32)) for r in rows]
    if not examples:
        return None
    examples.sort(key=lambda e: (int(e[1].sum()) * 2654435761 % (1 << 32), len(e[1]), e[0]))
    return fit(examples)


def score_toxicity(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    # Plain arrays, as executors may lack the class; at most a weight for each of the slots.
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.slots, model.weights, model.bias))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots_used, own_weights, bias = shared.value or ([], [], None)
        weights = np.zeros(1 << SLOT_BITS, dtype=np.float32)
        weights[slots_used] = own_weights
        for batch in batches:
            score = np.zeros(batch.num_rows)
            if bias is not None:
                for a, b, text, slots in _present(batch.column("text"), weights != 0):
                    sums = np.bincount(text, weights=weights[slots], minlength=b - a)
                    score[a:b] = 1 / (1 + np.exp(-np.clip(sums + bias, -30, 30)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(score),
                                              "predicted": pa.array((score >= THRESHOLD).astype(np.int32))})

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")
