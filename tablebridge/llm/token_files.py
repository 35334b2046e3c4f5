"""Token ids of a corpus as files of Simple-8b blocks, in ascending order of doc_id.

Documents are dealt out by ranges of doc_id and sorted, so a task writes a run of the
corpus. A file row is one block (see ``simple8b``) with the ids of its documents, its task
and the ids before it in that task; Parquet only carries the blocks, so Spark's commit
protocol keeps half-written and repeated attempts out. Reading adds up the tasks' totals,
one row each, and needs no order among blocks.

A null text is encoded as an empty one and has the end id alone. Null ids come first;
rows that share an id follow one another by a hash of their text; repeated rows are
written as often as they occur. An empty table gives an empty folder. No other column is read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablebridge.llm.batches import small_batches
from tablebridge.llm.bpe import read_tokenizer
from tablebridge.llm.simple8b import from_block, to_block
from tablebridge.llm.words import byte_hashes, chunks

END_ID = 0
BLOCK_IDS = 1 << 16  # a block ends with the document that reaches this many ids
KNOWN_PIECES = 1_500_000  # pieces that a worker remembers, about 40 bytes each
JOINED = 500  # new words that are encoded in one string

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_CONTRACTED = np.zeros(256, dtype=bool)
_CONTRACTED[list(b"stmdrvl")] = True


def _next(x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    out[:-1] = x[1:]
    return out


def plain_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has only ASCII and Latin-1 letters, no English contraction and no special token."""
    before = np.zeros_like(data)
    before[1:] = data[:-1]
    latin = (data == 0xC3) | (before == 0xC3) & (data != 0x97) & (data != 0xB7)
    after = _next(data)
    odd = (data >= 0x80) & ~latin | (data == ord("'")) & _CONTRACTED[after] | (data == ord("<")) & (after == ord("|"))
    seen = np.concatenate([[0], np.cumsum(odd)])[offsets]
    return np.diff(seen) == 0


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of plain texts begin.

    A piece is a run of letters, digits, white space or other characters. The last character
    of white space before another run stands alone, or leads that run if it is a blank.
    """
    kind = _KIND[data]
    start = np.ones(len(data), dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    start[first] = True
    behind = np.flatnonzero(start[1:] & (kind[1:] != _SPACE) & (kind[:-1] == _SPACE)) + 1
    led = np.zeros(len(data), dtype=bool)
    led[first] = True
    behind = behind[~led[behind]]  # white space of the text before does not count
    start[behind - 1] = True
    start[behind[data[behind - 1] == 0x20]] = False
    return np.flatnonzero(start)


class ByteBpe:
    """The tokenizers library with a byte-level vocabulary, asked once for each distinct piece of plain texts.

    Pieces are told apart by 64-bit hashes. Texts that are not plain go through the library whole.
    """

    def __init__(self, file: str):
        self.library = tokenizers.Tokenizer.from_str(file)
        # Ids whose string begins with a space, and so with a word.
        self.opens = np.zeros(self.library.get_vocab_size(), dtype=bool)
        self.opens[[i for s, i in self.library.get_vocab().items() if s[0] == "Ġ"]] = True
        self._forget()

    def _forget(self) -> None:
        self.known, self.begin, self.length = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _whole(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        ids = [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return ids, [np.array([len(x)]) for x in ids]

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        # Words behind one blank fall apart again when they are joined, so one call encodes many.
        joinable = np.array([p[0] == " " and p[1:].isalpha() for p in pieces], dtype=bool)
        words, others = list(compress(pieces, joinable)), list(compress(pieces, ~joinable))
        ids, _ = self._whole(["".join(words[i:i + JOINED]) for i in range(0, len(words), JOINED)])
        lengths = [np.diff(np.append(np.flatnonzero(self.opens[x]), len(x))) for x in ids]
        more, singly = self._whole(others)
        length = np.concatenate([*lengths, *singly])
        begin = len(self.ids) + np.cumsum(length) - length
        self.ids = np.concatenate([self.ids, *ids, *more])
        new = np.concatenate([hashes[joinable], hashes[~joinable]])
        order = np.argsort(new)
        at = np.searchsorted(self.known, new[order])
        self.known = np.insert(self.known, at, new[order])
        self.begin, self.length = np.insert(self.begin, at, begin[order]), np.insert(self.length, at, length[order])

    def _places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        hashes, at, back = np.unique(byte_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        place = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        new = np.ones(len(hashes), dtype=bool) if not len(self.known) else self.known[place] != hashes
        if new.any():
            raw = data.tobytes()
            self._learn(hashes[new], [raw[s:e].decode() for s, e in zip(start[at[new]].tolist(), end[at[new]].tolist(), strict=True)])
            place = np.searchsorted(self.known, hashes)
        return place[back]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text) of UTF-8 texts."""
        plain = plain_texts(data, offsets)
        start = piece_starts(data, offsets)
        end = np.append(start[1:], len(data))[:len(start)]
        text = np.searchsorted(offsets, start, side="right") - 1
        own = plain[text]
        place = self._places(data, start[own], end[own])
        length, begin = self.length[place], self.begin[place]
        ends = np.cumsum(length)
        ids = self.ids[np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]
        counts = np.bincount(text[own], weights=length, minlength=len(plain)).astype(np.int64)
        if plain.all():
            return ids, counts
        edge = np.concatenate([[0], np.cumsum(counts)])
        odd = np.flatnonzero(~plain)
        whole = dict(zip(odd.tolist(), self._whole([data[offsets[i]:offsets[i + 1]].tobytes().decode() for i in odd])[0], strict=True))
        parts = [whole[i] if i in whole else ids[edge[i]:edge[i + 1]] for i in range(len(plain))]
        return np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)


def write_token_files(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Encode ``text`` with the tokenizer file at ``tokenizer`` (on the driver) and write blocks to ``path``."""
    # A vocabulary, of the same size for any input. A worker keeps the value for its later tasks, the encoder with it.
    shared = docs.sparkSession.sparkContext.broadcast({"file": read_tokenizer(tokenizer)})
    kind = docs.schema["doc_id"].dataType.simpleString()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
        kept = shared.value
        if "bpe" not in kept:
            kept["bpe"] = ByteBpe(kept["file"])
        bpe = kept["bpe"]
        values: list[np.ndarray] = []
        doc_ids: list = []
        counts: list[int] = []
        before, part, end_id = 0, None, np.array([END_ID], dtype=np.uint32)

        def block() -> pa.RecordBatch:
            nonlocal before
            places = np.cumsum([0, *counts])
            out = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "before": pa.array([before], pa.int64()), "n_ids": pa.array([int(places[-1])], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(doc_type)), "block": pa.array([to_block(np.concatenate(values), places)], pa.binary())})
            before += int(places[-1])
            values.clear()
            doc_ids.clear()
            counts.clear()
            return out

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for a, b, data, offsets in chunks(batch.column("text")):
                ids, n = bpe.encode(data, offsets)
                edge = np.concatenate([[0], np.cumsum(n)])
                for i, key in enumerate(batch.column("doc_id").slice(a, b - a).to_pylist()):
                    values += [ids[edge[i]:edge[i + 1]], end_id]
                    doc_ids.append(key)
                    counts.append(int(n[i]) + 1)
                    if counts[-1] >= BLOCK_IDS or len(counts) % 16 == 0 and sum(counts) >= BLOCK_IDS:
                        yield block()
        if counts:
            yield block()

    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange("doc_id", "digest", "row").sortWithinPartitions("doc_id", "digest", "row")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    with small_batches(docs.sparkSession):
        ordered.mapInArrow(blocks, f"part int, before bigint, n_ids bigint, doc_ids array<{kind}>, block binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids before it in the corpus) and its ids."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, keys, block in zip(batch.column("first"), batch.column("doc_ids"), batch.column("block"), strict=True):
                values, places = from_block(block.as_py())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": keys.values, "start": pa.array(first.as_py() + places[:-1], pa.int64()),
                    "ids": pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(values.astype(np.int64)))})

    return _with_first(files).mapInArrow(documents, f"doc_id {kind}, start bigint, ids array<bigint>")


def _with_first(files: DataFrame) -> DataFrame:
    """Blocks with the number of ids before them in the corpus.

    There is one offset for each task that wrote, which bounds what is broadcast.
    """
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    return files.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("before")).alias("first"), "doc_ids", "block")


def token_report(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens and the CRC-32 of its ids."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, keys, block in zip(batch.column("first"), batch.column("doc_ids"), batch.column("block"), strict=True):
                values, places = from_block(block.as_py())
                ids = values.astype("<u4")
                yield pa.RecordBatch.from_pydict({
                    "doc_id": keys.values, "start": pa.array(first.as_py() + places[:-1], pa.int64()), "n_tokens": pa.array(np.diff(places), pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[a:b].data) for a, b in zip(places[:-1], places[1:], strict=True)], pa.int64())})

    return _with_first(files).mapInArrow(digests, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
