"""Byte-pair encoding and decoding with a word-end vocabulary.

A text is cut at the strings of special tokens, normalised (NFC, lower case), split into
pieces, and each piece is merged: its symbols form a doubly linked list, a priority queue
holds the ranks of mergeable neighbours, and entries whose symbols have changed meanwhile
are skipped. Decoding joins the vocabulary strings of the ids as the file's missing
decoder asks for: with one space between.

What is a letter, a small letter or white space depends on the version of Unicode. Texts of
Latin letters, common punctuation and CJK ideographs (PLAIN) mean the same in all. Parts with any
other character take normalisation and pieces from the tokenizers library's own rules, whose Unicode
may differ from Python's; the merges are the same.

A null text is encoded as an empty one: no ids, an empty decoded text. Rows are encoded
one by one, so repeated rows and null or repeated ids are unaffected, an empty table gives
an empty result, and no other column is read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from tablebridge.llm.batches import slices, tidy

CACHED_PIECES = 100_000  # merged pieces that a worker remembers, about 160 bytes each, and as many older ones
CACHED_CHARS = 48  # longer ones are merged each time
_ID_BITS, _PLACE_BITS = 24, 40
_PLACES = (1 << _PLACE_BITS) - 1
PLAIN = re.compile("[\t-\r\x20-\x7e\x80-\u024f\u2010-\u2027\u2030-\u205e\u4e00-\u9fa5]*")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _of_plain(pattern: str) -> re.Pattern:
    """The same pattern for lower-cased PLAIN texts, its properties written out, as Python's own expressions are faster."""
    chars = sorted({x for c in map(chr, range(0x10000)) if PLAIN.fullmatch(c) for x in c.lower()})
    for name in set(re.findall(r"\\p\{\w+\}", pattern)):
        runs: list[list[int]] = []
        for c in filter(regex.compile(name).match, chars):
            if runs and runs[-1][1] == ord(c) - 1:
                runs[-1][1] += 1
            else:
                runs.append([ord(c), ord(c)])
        pattern = pattern.replace(name, "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in runs))
    return re.compile(pattern)


class _Known(dict):
    """Ids of pieces that have been merged, the last CACHED_PIECES and as many before them."""

    def __init__(self, merged: Callable[[str], tuple]):
        super().__init__()
        self.merged, self.older = merged, {}

    def __missing__(self, piece: str) -> tuple:
        found = self.older.get(piece) or self.merged(piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found


class WordBpe:
    """The encoder and decoder of a tokenizer file with word ends and no decoder."""

    def __init__(self, file: str):
        self.file, self.library = file, None
        spec = json.loads(file)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        ids = model["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # The rank of a pair, and what a rank makes of its pair.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[ids[a] << _ID_BITS | ids[b]] = rank
            self.made.append(ids[a + b])
        self.inner = {s: ids[s] for s in byte_symbols()}
        self.last = {s: ids[s + end] for s in byte_symbols()}
        self.of_byte, self.of_last = list(self.inner.values()), list(self.last.values())
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.specials.items()}
        self.numbers = {i: str(i) for i in self.strings}
        # Unicode's own white space, as the file's pattern means it
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pieces = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split").replace(r"\s", r"\p{White_Space}"))
        self.plain_pieces = _of_plain(self.pieces.pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.known = _Known(self.piece)

    def merge(self, ids: list[int]) -> list[int]:
        """Ids of one piece, given as its bytes' ids: always the lowest rank first, the leftmost of equal ones.

        A queue entry is a rank and the place of the pair's left symbol in one number. ``ranked``
        holds the rank of the pair that begins at a place now, so an entry that differs is skipped.
        """
        n, rank, made = len(ids), self.ranks.get, self.made
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranked = [rank(a << _ID_BITS | b, -1) for a, b in pairwise(ids)]
        ranked.append(-1)
        queue = [r << _PLACE_BITS | i for i, r in enumerate(ranked) if r >= 0]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            left, r = entry & _PLACES, entry >> _PLACE_BITS
            if ranked[left] != r:
                continue  # one of the two has been merged since
            right = after[left]
            after[left] = behind = after[right]
            ids[left] = new = made[r]
            ids[right] = ranked[right] = ranked[left] = -1
            if behind < n:
                before[behind] = left
                ranked[left] = r = rank(new << _ID_BITS | ids[behind], -1)
                if r >= 0:
                    heapq.heappush(queue, r << _PLACE_BITS | left)
            first = before[left]
            if first >= 0:
                ranked[first] = r = rank(ids[first] << _ID_BITS | new, -1)
                if r >= 0:
                    heapq.heappush(queue, r << _PLACE_BITS | first)
        return [i for i in ids if i >= 0]

    def piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        ids = list(map(self.of_byte.__getitem__, raw))
        ids[-1] = self.of_last[raw[-1]]
        return tuple(self.merge(ids))

    def foreign(self, text: str) -> Iterator[int]:
        """The ids of a text whose characters the library has to judge."""
        if self.library is None:
            self.library = tokenizers.Tokenizer.from_str(self.file)
        for symbols, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text)):
            yield from self.merge([*map(self.inner.__getitem__, symbols[:-1]), self.last[symbols[-1]]])

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.cut.split(text):
            if part in self.specials:
                out.append(self.specials[part])
            elif PLAIN.fullmatch(part):
                out += chain.from_iterable(map(self.known.__getitem__, self.plain_pieces.findall(part.lower())))
            else:
                out += self.foreign(part)
        return out

    def written(self, ids: list[int]) -> str:
        return " ".join(map(self.numbers.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.strings.__getitem__, ids))


def _per_batch(spark, file: str, column: Callable[[WordBpe, pa.Array], dict[str, pa.Array]], lasting: bool = True) -> Callable:
    # A vocabulary, of the same size for any input. A worker keeps the value for its later tasks, the encoder with it if it is lasting.
    shared = spark.sparkContext.broadcast({"file": file})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value if lasting else dict(shared.value)
        if "bpe" not in kept:
            kept["bpe"] = WordBpe(kept["file"])
        for batch in slices(batches):
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            yield pa.RecordBatch.from_pydict(columns | column(kept["bpe"], batch.column("text")))
        if not lasting:
            kept.clear()  # before the memory is given back

    return tidy(run)


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_column(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the ids of each text; ``tokenizer`` is the path of the file on the driver."""

    def ids(bpe: WordBpe, texts: pa.Array) -> dict[str, pa.Array]:
        return {"ids": pa.array([bpe.encode(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_per_batch(docs.sparkSession, read_tokenizer(tokenizer), ids), f"doc_id {kind}, ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str, with_ids: bool = False, lasting: bool = True) -> DataFrame:
    """Per row: doc_id, n_tokens and the SHA-256 of the ids and of the text decoded from them; on demand the ids.

    A lasting encoder stays with a worker for its later tasks; any other goes with its task, as idle workers hold memory too.
    """

    def digests(bpe: WordBpe, texts: pa.Array) -> dict[str, pa.Array]:
        count, ids, decoded, lists = [], [], [], []
        for text in texts:
            own = bpe.encode(text.as_py() or "")
            count.append(len(own))
            ids.append(hashlib.sha256(bpe.written(own).encode()).hexdigest())
            decoded.append(hashlib.sha256(bpe.decode(own).encode()).hexdigest())
            if with_ids:
                lists.append(np.array(own, dtype=np.int32))
        columns = {"n_tokens": pa.array(count, pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
        return columns | ({"ids": pa.array(lists, pa.list_(pa.int32()))} if with_ids else {})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _per_batch(docs.sparkSession, read_tokenizer(tokenizer), digests, lasting),
        f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{', ids array<int>' if with_ids else ''}")
