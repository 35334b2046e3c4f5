"""A small character convolutional network in numpy: embedding, one convolution, maxima, a logistic unit."""

from __future__ import annotations

import numpy as np

from tablebridge.llm.boosting import sigmoid

CLASSES = 72  # 0: nothing, then the printable ASCII characters with letters kept apart, last: all else
EMBED, WIDTH, FILTERS = 10, 5, 24


def char_codes() -> np.ndarray:
    """The class of each code point below 128: letters and digits have their own, other characters share some."""
    out = np.full(128, CLASSES - 1, dtype=np.int64)
    out[48:58] = np.arange(1, 11)
    out[65:91] = np.arange(11, 37)
    out[97:123] = out[65:91] + 26
    for i, c in enumerate("-_+/=.:\"' "):
        out[ord(c)] = min(63 + i, CLASSES - 2)
    return out


_CODES = char_codes()


def encode(texts: list[str], width: int) -> np.ndarray:
    """A row of ``width`` classes for each text."""
    out = np.zeros((len(texts), width), dtype=np.int64)
    for row, text in zip(out, texts, strict=True):
        points = np.frombuffer(text[:width].encode("utf-32-le", "replace"), dtype=np.uint32)
        row[:len(points)] = np.where(points < 128, _CODES[np.minimum(points, 127)], CLASSES - 1)
    return out


def start(seed: int = 10) -> list[np.ndarray]:
    r = np.random.default_rng(seed)
    return [r.normal(0, 0.3, (CLASSES, EMBED)), r.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)), np.zeros(FILTERS),
            r.normal(0, 0.2, 2 * FILTERS), np.zeros(1)]


def _forward(params: list[np.ndarray], x: np.ndarray, split: int) -> tuple:
    embed, kernel, bias, out, offset = params
    windows = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)  # row, place, character
    seen = embed[windows].reshape(*windows.shape[:2], -1)
    hidden = np.maximum(seen @ kernel + bias, 0)
    # the context before the candidate and the candidate itself have maxima of their own
    first, second = hidden[:, :split].argmax(axis=1), split + hidden[:, split:].argmax(axis=1)
    rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
    pooled = np.concatenate([hidden[rows, first, cols], hidden[rows, second, cols]], axis=1)
    return windows, seen, first, second, pooled, pooled @ out + offset[0]


def margins(params: list[np.ndarray], x: np.ndarray, split: int, at_once: int = 256) -> np.ndarray:
    parts = [_forward(params, x[i:i + at_once], split)[-1] for i in range(0, len(x), at_once)]
    return np.concatenate(parts) if parts else np.zeros(0)


def fit(x: np.ndarray, y: np.ndarray, split: int) -> list[np.ndarray]:
    return descend(start(), x, y, split, epochs=8)


def descend(params: list[np.ndarray], x: np.ndarray, y: np.ndarray, split: int, epochs: int, batch: int = 64, rate: float = 3e-3) -> list[np.ndarray]:
    """Adam on the logistic loss, from ``params``."""
    r = np.random.default_rng(11)
    params = list(params)
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = r.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i:i + batch]
            windows, seen, first, second, pooled, margin = _forward(params, x[rows], split)
            d = (sigmoid(margin) - y[rows]) / len(rows)
            d_pooled = d[:, None] * params[3][None, :] * (pooled > 0)
            d_hidden = np.zeros((*windows.shape[:2], FILTERS))
            at, cols = np.arange(len(rows))[:, None], np.arange(FILTERS)[None, :]
            d_hidden[at, first, cols] += d_pooled[:, :FILTERS]
            d_hidden[at, second, cols] += d_pooled[:, FILTERS:]
            flat = d_hidden.reshape(-1, FILTERS)
            d_embed = np.zeros_like(params[0])
            np.add.at(d_embed, windows.reshape(-1), (flat @ params[1].T).reshape(-1, EMBED))
            gradients = [d_embed, seen.reshape(-1, WIDTH * EMBED).T @ flat, flat.sum(axis=0), pooled.T @ d, d.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(gradients):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                params[k] = params[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return params
