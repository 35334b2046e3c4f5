"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is good or bad. A line's features are shares of symbols, capitals,
digits and the like in steps, whether the line or its word triples occur elsewhere in the
text, and the same facts of the lines before and after; neighbouring labels are coupled by
a transition table. Forward-backward marginals, weighted by the lines' lengths, give the
share of good text, and a logistic curve turns it into the score.

Labels exist for documents only. Training starts with every line labelled as its document,
then lines of bad documents that the model itself takes for good are relabelled, once a
round. It reads a bounded sample of labelled rows outside the held-out fold (SAMPLE_ROWS,
documents of more than TRAINED_LINES lines left out); every text is scored whole, with
documents of any number of lines.

A null, empty or wordless text has no line and scores 0; so does every text if there are
no labels to learn from. Rows are scored one by one, so repeated rows and null or repeated
ids are unaffected (a null id is not held out); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.labelled import held_out, training_rows
from tablebridge.llm.words import SPACED, chunks, ngrams, split_words

SAMPLE_ROWS = 3_000
TRAINED_LINES = 300
ROUNDS = 2
STEPS = 80
RATE = 0.15
L2 = 1e-3
THRESHOLD = 0.3

_SETS = {
    "symbol": b"#*$%&|<>^~_=+@{}[]\\/",
    "shout": b"!?",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)) + bytes(range(0xC0, 0x100)),
    "digit": b"0123456789",
    "stop": b".,;:",
    "bar": b"|",
}
_CUTS = {  # a feature for each cut that a line's share exceeds
    "symbol": (0.0, 0.02, 0.06, 0.12), "shout": (0.0, 0.02, 0.08), "upper": (0.15, 0.5), "digit": (0.0, 0.1, 0.3),
    "stop": (0.0, 0.05), "bar": (0.0, 0.02, 0.06), "repeat": (0.0, 0.2, 0.5), "twin": (0.5,), "long_words": (6.5, 9.0), "short": (-20.0, -8.0), "length": (30.0, 120.0, 500.0),
}
_SHARED = ("symbol", "shout", "upper", "bar", "repeat", "twin")  # told of the neighbours too, at the middle cut
N_FEATURES = 1 + sum(map(len, _CUTS.values())) + 2 * (len(_SHARED) + 1)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, length, features) of every line with a word."""
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    start = start[start < len(data)]
    end = np.append(start[1:], len(data))[:len(start)]
    end = np.where(data[end - 1] == 10, end - 1, end)  # no start is at the end of the data, so no run is empty
    w = split_words(data, offsets, SPACED)
    low, high = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
    kept = high > low
    start, end, low, high = start[kept], end[kept], low[kept], high[kept]
    text = np.searchsorted(offsets, start, side="right") - 1
    length = np.maximum(end - start, 1).astype(np.float64)
    words = (high - low).astype(np.float64)

    def inside(flags: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return (total[b] - total[a]).astype(np.float64)

    share = {}
    for name, chars in _SETS.items():
        table = np.zeros(256, dtype=bool)
        table[list(chars)] = True
        share[name] = inside(table[data], start, end)
    letters = np.maximum(share["upper"] + share["lower"], 1)
    share = {n: v / (letters if n == "upper" else length) for n, v in share.items()}
    share["repeat"] = inside(_repeated(*ngrams(w, 3), w.first, len(w.hash)), low, high) / words
    share["twin"] = _twins(w.hash, low, high, text)
    share["long_words"] = length / words - 1
    share["short"] = -words
    share["length"] = length
    columns = [np.ones(len(start))] + [share[n] > cut for n, cuts in _CUTS.items() for cut in cuts]
    own = [share[n] > _CUTS[n][len(_CUTS[n]) // 2] for n in _SHARED]
    first = np.ones(len(start), dtype=bool)
    first[1:] = text[1:] != text[:-1]
    last = np.append(first[1:], True)[:len(start)]
    for flags in own:
        columns += [np.where(first, False, np.roll(flags, 1)), np.where(last, False, np.roll(flags, -1))]
    columns += [first, last]
    return text, length, np.stack(columns, axis=1).astype(np.float32)


def _same_pairs(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether the value occurs twice or more in its text."""
    order = np.lexsort((value, text))
    t, v = text[order], value[order]
    equal = np.zeros(len(t), dtype=bool)
    if len(t) > 1:
        same = (t[1:] == t[:-1]) & (v[1:] == v[:-1])
        equal[1:] |= same
        equal[:-1] |= same
    out = np.zeros(len(t), dtype=bool)
    out[order] = equal
    return out


def _repeated(hashes: np.ndarray, whole: np.ndarray, first: np.ndarray, n_words: int) -> np.ndarray:
    out = np.zeros(n_words, dtype=bool)
    at = np.flatnonzero(whole)
    twice = at[_same_pairs(np.searchsorted(first, at, side="right"), hashes[at])]
    for k in range(3):
        out[twice + k] = True
    return out


def _twins(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether another line of the text has the same words."""
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(low, high - low).astype(np.uint64) if len(low) else np.zeros(0, dtype=np.uint64)
    salted = (hashes ^ (hashes >> np.uint64(31))) * (np.uint64(2) * place + np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(salted, dtype=np.uint64)])
    return _same_pairs(text, total[high] - total[low]).astype(np.float64)


def _layout(text: np.ndarray) -> list[np.ndarray]:
    """Lines by their place in the text: the t-th lines of all texts that have so many, longest text first."""
    if not len(text):
        return []
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    count = np.diff(np.append(first, len(text)))
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    alive = np.searchsorted(-count, -np.arange(count[0]), side="left")
    return [first[:n] + t for t, n in enumerate(alive)]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(features: np.ndarray, text: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probabilities of bad and good for each line, expected transitions summed over all lines)."""
    emit = np.stack([np.zeros(len(features)), features @ weights], axis=1)
    steps = _layout(text)
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    for t, rows in enumerate(steps):
        before = steps[t - 1][:len(rows)] if t else None
        forward[rows] = emit[rows] + (_log_sum(forward[before][:, :, None] + moves, 1) if t else 0.0)
    pairs = np.zeros((2, 2))
    for t in range(len(steps) - 1, 0, -1):
        rows, before = steps[t], steps[t - 1][:len(steps[t])]
        reach = (emit + backward)[rows] if t == len(steps) - 1 else emit[rows] + backward[rows]
        joint = moves + reach[:, None, :]
        backward[before] = _log_sum(joint, 2)
        joint = forward[before][:, :, None] + joint
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = forward + backward
    both = np.exp(both - both.max(axis=1, keepdims=True)) if len(both) else both
    return both / both.sum(axis=1, keepdims=True), pairs


def fit(features: np.ndarray, text: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of good lines and the transition table, by Adam on the conditional likelihood; y labels lines."""
    size = features.shape[1] + 4
    x, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    next_to = np.flatnonzero(text[1:] == text[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[next_to], y[next_to + 1]), 1)
    for step in range(1, STEPS + 1):
        p, pairs = marginals(features, text, x[:-4], x[-4:].reshape(2, 2))
        gradient = np.concatenate([features.T @ (y - p[:, 1]), (seen - pairs).ravel()]) / len(y) - L2 * x
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        x += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return x[:-4], x[-4:].reshape(2, 2)


def good_share(p: np.ndarray, text: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Length-weighted share of good text; -1 for a text without lines."""
    total = np.bincount(text, weights=length, minlength=n)
    return np.where(total > 0, np.bincount(text, weights=length * p, minlength=n) / np.maximum(total, 1), -1.0)


def _curve(share: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on a slightly shrunk likelihood."""
    x = np.stack([np.log((share + 0.01) / (1.01 - share)), np.ones(len(share))], axis=1)
    b = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        b += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), x.T @ (y - p) - 0.1 * b)
    return float(b[0]), float(b[1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple | None:
    """(weights, transitions, slope, offset), or None without labels. Lines' features are worked out on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                text, length, features = line_features(data, offsets)
                edges = np.searchsorted(text, np.arange(b - a + 1))
                fit_for = np.flatnonzero((np.diff(edges) > 0) & (np.diff(edges) <= TRAINED_LINES))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id").cast(pa.string()).take(pa.array(fit_for)), "y": part.column("y").take(pa.array(fit_for)),
                    "length": pa.array([length[edges[i]:edges[i + 1]] for i in fit_for], pa.list_(pa.float64())),
                    "bits": pa.array([np.packbits(features[edges[i]:edges[i + 1]] > 0).tobytes() for i in fit_for], pa.binary())})

    rows = training_rows(docs, labels, "quality", sample_rows).select("doc_id", "text", F.col("y").cast("int").alias("y"))
    found = sorted(rows.mapInArrow(run, "doc_id string, y int, length array<double>, bits binary").toLocalIterator(), key=lambda r: (r.doc_id, r.bits))
    if not found:
        return None
    counts = np.array([len(r.length) for r in found])
    text = np.repeat(np.arange(len(found)), counts)
    length = np.concatenate([np.array(r.length) for r in found])
    features = np.concatenate([np.unpackbits(np.frombuffer(r.bits, dtype=np.uint8))[:n * N_FEATURES].reshape(n, N_FEATURES)
                               for r, n in zip(found, counts, strict=True)]).astype(np.float32)
    of_doc = np.array([r.y for r in found])
    y = of_doc[text]
    for _ in range(ROUNDS):
        weights, moves = fit(features, text, y)
        p = marginals(features, text, weights, moves)[0][:, 1]
        least = np.full(len(found), 2.0)
        np.minimum.at(least, text, p)
        # a bad document keeps its worst line bad
        y = np.where((of_doc[text] == 0) & ((p < 0.5) | (p <= least[text])), 0, 1)
    return weights, moves, *_curve(good_share(p, text, length, len(found)), of_doc)


def score_quality(docs: DataFrame, model: tuple | None) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few dozen numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for a, b, data, offsets in chunks(batch.column("text") if shared.value else batch.column("text").slice(0, 0)):
                weights, moves, slope, offset = shared.value
                text, length, features = line_features(data, offsets)
                share = good_share(marginals(features, text, weights, moves)[0][:, 1], text, length, b - a)
                known = np.clip(share, 0, 1)
                score[a:b] = np.where(share < 0, 0.0, 1 / (1 + np.exp(-(slope * np.log((known + 0.01) / (1.01 - known)) + offset))))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(score),
                                              "predicted": pa.array((score >= THRESHOLD).astype(np.int32))})

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")
