"""Integers packed into 64-bit words: four bits choose how many share the other sixty.

A block is a run of little-endian 64-bit words: MAGIC, the numbers of documents, packed
words and escapes, the place of each document's first value and of the end, the packed
words, the escapes. Values beyond 60 bits are escapes: their packed word has the selector
ESCAPE and nothing else, their values stand in order behind. As no word depends on the
one before, all words of a selector are unpacked at once.
"""

from __future__ import annotations

import numpy as np

MAGIC = 0x3142385350_4D53
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])  # values in a word by selector; bits are 60 // count
ESCAPE = 15


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed words, escapes) of unsigned 64-bit values: each word takes as many as fit."""
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    # The widest of the next k values, for growing k, decides which selectors fit at each place.
    escaped = values >= np.uint64(1 << 60)
    # frexp gives the bits of what a double holds exactly; larger values count as 60
    width = np.where(values < np.uint64(1 << 52), np.maximum(np.frexp(values.astype(np.float64))[1], 1), 60).astype(np.uint8)
    width[escaped] = 61
    chosen = np.full(n, len(COUNTS) - 1, dtype=np.uint8)
    widest, k = width.copy(), 1
    for selector in range(len(COUNTS) - 2, -1, -1):
        count = int(COUNTS[selector])
        if count > n:
            break
        # widest[i] spans k values; the same array shifted by count - k (at most k) spans the rest
        while k < count:
            step = min(k, count - k)
            widest = np.maximum(widest[:len(widest) - step], widest[step:])
            k += step
        fits = widest <= 60 // count
        if not fits.any():
            break
        chosen[:len(fits)][fits] = selector
    step = COUNTS[chosen].tolist()
    heads: list[int] = []
    add, i = heads.append, 0
    while i < n:
        add(i)
        i += step[i]
    head = np.array(heads, dtype=np.int64)
    selector = chosen[head]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s, count in enumerate(COUNTS.tolist()):
        rows = np.flatnonzero(selector == s)
        for j in range(count if rows.size else 0):
            words[rows] |= np.where(escaped[head[rows]], np.uint64(0), values[head[rows] + j]) << np.uint64(j * (60 // count))
    words[escaped[head]] = np.uint64(ESCAPE << 60)
    return words, values[escaped]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    per_word = np.append(COUNTS, [0, 1])[selector]
    begin = np.cumsum(per_word) - per_word
    out = np.zeros(int(per_word.sum()), dtype=np.uint64)
    for s, count in enumerate(COUNTS.tolist()):
        rows = np.flatnonzero(selector == s)
        bits = 60 // count
        mask = np.uint64((1 << bits) - 1)
        for j in range(count if rows.size else 0):
            out[begin[rows] + j] = (words[rows] >> np.uint64(j * bits)) & mask
    out[begin[selector == ESCAPE]] = escapes
    return out


def to_block(values: np.ndarray, places: np.ndarray) -> bytes:
    words, escapes = pack(values)
    head = np.array([MAGIC, len(places) - 1, len(words), len(escapes)], dtype=np.uint64)
    return np.concatenate([head, places.astype(np.uint64), words, escapes]).astype("<u8").tobytes()


def from_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(values, places) of a block."""
    all_words = np.frombuffer(block, dtype="<u8")
    magic, docs, packed, _ = (int(x) for x in all_words[:4])
    if magic != MAGIC:
        raise ValueError("not a block of packed ids")
    body = 4 + docs + 1
    return unpack(all_words[body:body + packed], all_words[body + packed:]), all_words[4:body].astype(np.int64)
