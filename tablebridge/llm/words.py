"""Words, n-gram hashes and shingle sets of Arrow text columns, a few megabytes of text at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts handled at once; a longer text is a chunk of its own
_LONG_WORD = 64  # bytes; longer words are hashed one by one
_SEED, _PRIME, _MIX = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only


def _table(chars) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] of lower-cased UTF-8: digits, letters and all beyond ASCII.
ALNUM = _table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: [^\x20\x09-\x0D]
SPACED = ~_table([0x20, *range(0x09, 0x0E)])


@dataclass
class Words:
    """The words of some texts: text i has the words first[i] to first[i + 1]."""

    data: np.ndarray  # lower-cased bytes of the texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def span(self, a: int, b: int) -> list[bytes]:
        return [self.data[s:e].tobytes() for s, e in zip(self.start[a:b], self.end[a:b], strict=True)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes."""
    length = end - start
    out = np.full(len(start), _SEED, dtype=np.uint64)
    left = np.flatnonzero(length <= _LONG_WORD)
    at = 0
    while left.size:
        out[left] = (out[left] ^ data[start[left] + at]) * _PRIME
        at += 1
        left = left[length[left] > at]
    for i in np.flatnonzero(length > _LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return mixed(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins; a null text is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from text, to text, bytes, offsets) of consecutive texts."""
    data, offsets = text_bytes(column)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, side="right")) - 1)
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def split_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = ALNUM) -> Words:
    data = LOWER[data]
    word = inside[data]
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:], after[:-1] = word[:-1], word[1:]
    edges = offsets[1:-1]
    before[edges[edges < len(word)]] = False
    after[edges[edges > 0] - 1] = False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), byte_hashes(data, start, end))


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words by their first word, and whether all n are of one text."""
    size = len(w.hash)
    if size < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    out = w.hash[:size - n + 1].copy()
    for k in range(1, n):
        out = out * _PRIME + w.hash[k:size - n + 1 + k]
    last = np.repeat(w.first[1:], w.counts())[:size - n + 1]
    return mixed(out), np.arange(size - n + 1) + n <= last


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text, ascending, and where each text's begin.

    A text of fewer words, but not none, has its whole sequence as one shingle.
    """
    hashes, whole = ngrams(w, n)
    counts = w.counts()
    at = np.flatnonzero(whole)
    text = np.repeat(np.arange(len(counts)), counts)[at]
    values = hashes[at]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if short.size:
        extra = np.zeros(len(short), dtype=np.uint64)
        for k, i in enumerate(short):
            own = np.array([counts[i]], dtype=np.uint64)  # an array, as its products wrap silently
            for j in range(w.first[i], w.first[i + 1]):
                own = own * _PRIME + w.hash[j:j + 1]
            extra[k] = own[0]
        text, values = np.concatenate([text, short]), np.concatenate([values, mixed(extra)])
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    text, values = text[new], values[new]
    return values, np.searchsorted(text, np.arange(len(counts) + 1))
