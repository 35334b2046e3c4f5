"""Ranked lexical search: the best documents for each item of a query set.

Every document is scored by integers alone, so ranks are exact. Items go in blocks of bounded
size; for each block the documents' postings of the block's terms are written once, with
document lengths, and the numbers that weights need (documents, words, documents of a term)
are counted over all of them. Then every task ranks its own documents, some thousands at a
time, and the best of all tasks are merged.

Within such a lot of documents the ranking is a hybrid of two orders of evaluation. An item's
short lists go term at a time: their scores are summed into accumulators, one sorted list that
from then on is an iterator like any other, with the largest sum of each document range as its
bound. It and the long lists are then passed document at a time, range by range: where the
bounds of all iterators together stay below the item's worst kept score, all of them skip the
range; elsewhere they seek to it and its documents are scored. The worst kept score carries
over from lot to lot, so most ranges are skipped once a task has seen a few good documents.

Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased, kept as 64-bit
hashes. A null text has none and counts nowhere. Items without terms have no rows; equal rows
of the query set are one item, rows that share an id but not the text are ranked apart, a null
item id included. Equal documents are ranked one by one; equal scores by ascending doc_id, null
ids last. Ids of documents are whole numbers. Other columns play no part; without documents or
items the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.llm.batches import stage
from tablebridge.llm.words import chunks, split_words

BEST = 20
BLOCK_BYTES = 4 << 20  # of item texts whose terms are broadcast at once
LOT = 8192  # documents that a task ranks at once
LOT_POSTINGS = 2_000_000
RANGE = 128  # documents that are skipped together
SHORT = 64  # documents of a list that is summed into the accumulators
_NO_ID = np.iinfo(np.int64).max  # a null id, behind all others


class Items(NamedTuple):
    """A block of items: their ids and their terms as places in the block's sorted vocabulary."""

    ids: pa.Array
    vocabulary: np.ndarray  # uint64
    first: np.ndarray  # item i has the terms first[i] to first[i + 1]
    terms: np.ndarray
    repeats: np.ndarray


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items to their distinct terms and the repeats of each."""
    for batch in batches:
        for a, b, data, offsets in chunks(batch.column("text")):
            w = split_words(data, offsets)
            found = [np.unique(w.hash[w.first[i]:w.first[i + 1]], return_counts=True) for i in range(b - a)]
            yield pa.RecordBatch.from_pydict({
                "item_id": batch.column("item_id").slice(a, b - a),
                "terms": pa.array([x.view(np.int64) for x, _ in found], pa.list_(pa.int64())),
                "repeats": pa.array([n for _, n in found], pa.list_(pa.int64()))})


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The items in blocks of about BLOCK_BYTES of text; a longer item makes its block longer."""
    kind = items.schema["item_id"].dataType.simpleString()
    distinct = items.select("item_id", "text").filter("text IS NOT NULL").distinct()
    size = distinct.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    split = stage(distinct.mapInArrow(_counted, f"item_id {kind}, terms array<bigint>, repeats array<bigint>").filter(F.size("terms") > 0), "items")
    for block in range(blocks):
        rows = split.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        ids, terms, repeats = (rows.column(c).chunk(0) for c in ("item_id", "terms", "repeats"))
        hashes = terms.flatten().to_numpy().view(np.uint64)
        vocabulary, places = np.unique(hashes, return_inverse=True)
        yield Items(ids, vocabulary, np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())]), places, repeats.flatten().to_numpy())


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per document with terms: doc_id, n (its terms with repeats), and those of the vocabulary with their occurrences."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column("text")):
                w = split_words(data, offsets)
                n = w.counts()
                place = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
                hit = known[place] == w.hash
                text = np.repeat(np.arange(b - a), n)[hit]
                both, times = np.unique(text * len(known) + place[hit], return_counts=True)
                edges = pa.array(np.searchsorted(both, np.arange(b - a + 1) * len(known)), pa.int32())
                rows = pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(a, b - a).cast(pa.int64()), "n": pa.array(n, pa.int64()),
                    "terms": pa.ListArray.from_arrays(edges, pa.array(both % len(known), pa.int32())),
                    "times": pa.ListArray.from_arrays(edges, pa.array(times, pa.int32()))})
                yield rows.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(post, "doc_id bigint, n bigint, terms array<int>, times array<int>")


class Lot:
    """The inverted lists of some thousand documents, which are numbered from 0."""

    def __init__(self, n: np.ndarray, counts: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray, documents: int, words: int):
        m = 100 - 25 + (25 * n * documents) // words
        doc = np.repeat(np.arange(len(n)), counts)
        times = times.astype(np.int64)
        score = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
        order = np.argsort(terms, kind="stable")
        self.size, self.ranges = len(n), -(-len(n) // RANGE)
        self.doc, self.score = doc[order], score[order]
        self.terms, first = np.unique(terms[order], return_index=True)
        self.first = np.append(first, len(order))
        self.known: dict[int, tuple] = {}

    def lists(self, terms: np.ndarray, repeats: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(number of the list, begin, end, repeats) of the terms that the lot holds."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        for k in np.flatnonzero(self.terms[at] == terms):
            yield int(at[k]), int(self.first[at[k]]), int(self.first[at[k] + 1]), int(repeats[k])

    def bounded(self, doc: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a list enters each range, and its largest score there."""
        edges = np.searchsorted(doc, np.arange(self.ranges + 1) * RANGE)
        most = np.zeros(self.ranges, dtype=np.int64)
        held = np.flatnonzero(edges[1:] > edges[:-1])
        most[held] = np.maximum.reduceat(score, edges[held])
        return edges, most

    def iterators(self, terms: np.ndarray, repeats: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
        """The accumulators of all short lists, then the long lists: (documents, scores, range edges, range bounds, repeats)."""
        short, out = [], []
        for k, a, b, times in self.lists(terms, repeats):
            if b - a <= SHORT:
                short.append((self.doc[a:b], self.score[a:b] * times))
            else:
                if k not in self.known:
                    self.known[k] = self.bounded(self.doc[a:b], self.score[a:b])
                out.append((self.doc[a:b], self.score[a:b], *self.known[k], times))
        if short:
            doc = np.concatenate([x for x, _ in short])
            order = np.argsort(doc, kind="stable")
            doc, first = np.unique(doc[order], return_index=True)
            score = np.add.reduceat(np.concatenate([x for _, x in short])[order], first)
            out.insert(0, (doc, score, *self.bounded(doc, score), 1))
        return out


class Best:
    """The best documents of one item so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc_id = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.least = 1  # the score that a further document needs

    def add(self, score: np.ndarray, doc_id: np.ndarray) -> None:
        score, doc_id = np.concatenate([self.score, score]), np.concatenate([self.doc_id, doc_id])
        order = np.lexsort((doc_id, -score))[:self.k]
        self.score, self.doc_id = score[order], doc_id[order]
        if len(order) == self.k:
            self.least = max(1, int(self.score[-1]))  # an equal score can still win by its id


def rank_lot(lot: Lot, doc_id: np.ndarray, terms: np.ndarray, repeats: np.ndarray, best: Best) -> int:
    """Take the lot's documents into account; returns how many ranges were scored."""
    iterators = lot.iterators(terms, repeats)
    if not iterators:
        return 0
    bound = sum(most * times for *_, most, times in iterators)
    scored = 0
    for r in np.flatnonzero(bound >= best.least).tolist():
        if bound[r] < best.least:
            continue  # the bar has risen meanwhile
        scored += 1
        base = r * RANGE
        total = np.zeros(RANGE, dtype=np.int64)
        for doc, score, edges, _, times in iterators:
            a, b = edges[r], edges[r + 1]
            if a < b:
                total[doc[a:b] - base] += score[a:b] * times
        good = np.flatnonzero(total >= best.least)
        if len(good):
            best.add(total[good], doc_id[base + good])
    return scored


def _ranker(shared: Any) -> Any:
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, documents, words, k = shared.value
        best = [Best(k) for _ in range(len(items.ids))]
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            doc_id, n, terms, times = (rows.column(c).chunk(0) for c in ("doc_id", "n", "terms", "times"))
            ids = doc_id.fill_null(_NO_ID).to_numpy()
            flat = terms.flatten().to_numpy()
            if not len(flat):
                return
            lot = Lot(n.to_numpy(), terms.value_lengths().to_numpy(), flat, times.flatten().to_numpy(), weights, documents, words)
            for i, own in enumerate(best):
                span = slice(items.first[i], items.first[i + 1])
                rank_lot(lot, ids, items.terms[span], items.repeats[span], own)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= LOT or sum(len(b.column("terms").flatten()) for b in held) >= LOT_POSTINGS:
                flush()
        if held:
            flush()
        for i, own in enumerate(best):
            if len(own.score):
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array(np.full(len(own.score), i), pa.int32()), "item_id": pa.repeat(items.ids[i], len(own.score)),
                    "doc_id": pa.array(own.doc_id, pa.int64(), mask=own.doc_id == _NO_ID), "score": pa.array(own.score, pa.int64())})

    return rank


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """Per item its ``k`` best documents: item_id, rank, doc_id and score."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    found = []
    for block in item_blocks(items):
        posted = stage(postings(docs, block.vocabulary), "postings")
        documents, words = posted.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        df = np.zeros(len(block.vocabulary), dtype=np.int64)
        held = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).toArrow()  # a row for each term of the block
        df[held.column("term").to_numpy()] = held.column("n").to_numpy()
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
        shared = spark.sparkContext.broadcast((block, weights, documents, words, k))
        best = posted.mapInArrow(_ranker(shared), f"item int, item_id {kind}, doc_id bigint, score bigint")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found.append(best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.union, found)
