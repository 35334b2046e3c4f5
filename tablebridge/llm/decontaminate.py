"""Benchmark decontamination by winnowing.

Of every WINDOW - GRAM + 1 consecutive word 5-grams of a text the one with the least hash
(the last of equal ones) is kept as a fingerprint, so two texts that share WINDOW words
in a row share a fingerprint inside them. Fingerprints of documents are joined to those
of the benchmark; each meeting is extended word by word as far as any window around it
can reach, and runs of WINDOW words or more are hits. An item of fewer words is one
window: its whole hash is its fingerprint, and documents are hashed at its length too.

Documents first look their fingerprints up in a bitmap of fixed size that is built from
the whole benchmark. It only spares rows: what passes is joined and compared exactly,
and with a benchmark so large that the bitmap fills, everything passes.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A null or empty
text has no words and is clean; a null or wordless item has no window. Items of equal
text are matched once; null item ids are left out of the lists. Repeated documents get
one result each; rows that share an id but not the text are judged apart, null ids
included. Other columns pass through ``drop_contaminated`` whatever their names are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.batches import tidy
from tablebridge.llm.words import Words, chunks, mixed, ngrams, split_words
from tablebridge.session import stage

WINDOW = 13
GRAM = 5
SLOT_BITS = 22  # the bitmap has 4 million slots, half a megabyte, whatever the benchmark's size
PERCENT = 5  # of a document's words

_HIT = pa.list_(pa.struct([("mark", pa.int64()), ("size", pa.int32()), ("anchor", pa.int32()), ("span", pa.string()), ("at", pa.list_(pa.int64()))]))
_HIT_SQL = "array<struct<mark: bigint, size: int, anchor: int, span: string, at: array<bigint>>>"
_RUNS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def winnowed(w: Words) -> np.ndarray:
    """Words at which the kept 5-grams of all texts begin."""
    hashes, _ = ngrams(w, GRAM)
    per_window = WINDOW - GRAM + 1
    if len(hashes) < per_window:
        return np.zeros(0, dtype=np.int64)
    last = np.repeat(w.first[1:], w.counts())[:len(hashes) - per_window + 1]
    begin = np.flatnonzero(np.arange(len(last)) + WINDOW <= last)
    views = np.lib.stride_tricks.sliding_window_view(hashes, per_window)[begin, ::-1]
    return np.unique(begin + per_window - 1 - views.argmin(axis=1))


def slot(mark: np.ndarray) -> np.ndarray:
    return (mark >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _marks(w: Words, lengths: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(window size, first words, hashes) of fingerprints: winnowed 5-grams, then whole windows of shorter items."""
    at = winnowed(w)
    yield WINDOW, at, mixed(ngrams(w, GRAM)[0][at] + np.uint64(WINDOW))
    for n in lengths:
        hashes, whole = ngrams(w, n)
        at = np.flatnonzero(whole)
        yield n, at, mixed(hashes[at] + np.uint64(n))


def fingerprinter(passing: np.ndarray | None, lengths: tuple[int, ...]) -> Callable:
    """Arrow batches with a column ``text`` to the same rows with n_words and hits in its place.

    ``passing`` is the bitmap, ``lengths`` the lengths of shorter items. Without a bitmap the
    texts are items: each has the fingerprints of its own length and no others. Equal
    fingerprints of a text with equal words around them are one hit with all their places. The
    first hit of each text stands for the text itself.
    """
    around = WINDOW - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b, data, offsets in chunks(texts):
                w = split_words(data, offsets)
                counts = w.counts()
                hits: list[dict] = [{(0, 0, 0, ""): [0]} for _ in range(b - a)]
                for size, at, marks in _marks(w, lengths if passing is not None else tuple(np.unique(counts[(counts > 0) & (counts < WINDOW)]))):
                    if passing is not None:
                        kept = passing[slot(marks)]
                        at, marks = at[kept], marks[kept]
                    text = np.searchsorted(w.first, at, side="right") - 1
                    for i, p, mark in zip(text.tolist(), at.tolist(), marks.view(np.int64).tolist(), strict=True):
                        lo, hi = int(w.first[i]), int(w.first[i + 1])
                        if passing is None and size < WINDOW and hi - lo != size:
                            continue
                        left, right = (max(lo, p - around), min(hi, p + WINDOW)) if size == WINDOW else (p, p + size)
                        span = b" ".join(w.span(left, right)).decode("utf-8", "replace")
                        hits[i].setdefault((mark, int(size), p - left, span), []).append(left - lo)
                part = batch.slice(a, b - a)
                columns = {n: part.column(n) for n in part.schema.names if n != "text"}
                columns["n_words"] = pa.array(counts, pa.int64())
                columns["hits"] = pa.array([[dict(zip(("mark", "size", "anchor", "span", "at"), (*h, at), strict=True)) for h, at in row.items()]
                                            for row in hits], _HIT)
                yield pa.RecordBatch.from_pydict(columns)

    return run


def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Meetings of a document and an item fingerprint to runs of equal words; null where there is no hit."""
    for batch in batches:
        runs: list[list | None] = []
        rows = (batch.column(n).to_pylist() for n in ("size", "at", "anchor", "span", "item_anchor", "item_span"))
        for size, at, a, span, b, item_span in zip(*rows, strict=True):
            if item_span is None:
                runs.append(None)
                continue
            ours, theirs = span.split(" "), item_span.split(" ")
            left = 0
            while left < min(a, b) and ours[a - left - 1] == theirs[b - left - 1]:
                left += 1
            right = 0
            while right < min(len(ours) - a, len(theirs) - b) and ours[a + right] == theirs[b + right]:
                right += 1
            if left + right < size:
                runs.append(None)
                continue
            found: list[list[int]] = []
            for place in at:  # ascending
                if found and place + a - left <= found[-1][1]:
                    found[-1][1] = place + a + right
                else:
                    found.append([place + a - left, place + a + right])
            runs.append([{"begin": x, "end": y} for x, y in found])
        columns = {n: batch.column(n) for n in ("doc_id", "digest", "n_words", "copies", "ids")}
        yield pa.RecordBatch.from_pydict(columns | {"runs": pa.array(runs, _RUNS)})


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, digest, n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").groupBy("text").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    marks = stage(
        items.mapInArrow(fingerprinter(None, ()), f"ids array<string>, n_words bigint, hits {_HIT_SQL}")
        .select("ids", F.explode("hits").alias("h")).filter("h.size > 0")
        # Items that share a fingerprint and the words around it are one row.
        .groupBy("h.mark", "h.size", F.col("h.anchor").alias("item_anchor"), F.col("h.span").alias("item_span"))
        .agg(F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids")), "fingerprints")
    # At most one row a slot, and one a length below WINDOW.
    slots = marks.select(F.shiftrightunsigned("mark", 64 - SLOT_BITS).alias("slot")).distinct().toArrow().column("slot").to_numpy()
    lengths = tuple(sorted(r[0] for r in marks.filter(F.col("size") < WINDOW).select("size").distinct().collect()))
    passing = np.zeros(1 << SLOT_BITS, dtype=bool)
    passing[slots] = True
    shared = spark.sparkContext.broadcast(np.packbits(passing))

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fingerprinter(np.unpackbits(shared.value).astype(bool), lengths)(batches)

    found = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
        .mapInArrow(tidy(fingerprints), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest bigint, n_words bigint, hits {_HIT_SQL}")
        .select("doc_id", "digest", "n_words", F.explode("hits").alias("h"))
        # A document's own row keeps a key of its own, so that such rows don't meet in one task.
        .select("doc_id", "digest", "n_words", "h.size", "h.at", "h.anchor", "h.span",
                F.when(F.col("h.size") > 0, F.col("h.mark")).otherwise(F.xxhash64("doc_id", "digest")).alias("mark"),
                (F.col("h.size") == 0).cast("int").alias("copies"))
    )
    runs = found.join(marks, ["mark", "size"], "left").select(
        "doc_id", "digest", "n_words", "copies", "ids", "size", "at", "anchor", "span", "item_anchor", "item_span").mapInArrow(
        tidy(extend), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest bigint, n_words bigint, copies int, ids array<string>, "
                "runs array<struct<begin: bigint, end: bigint>>")
    hit = F.col("runs").isNotNull()
    gathered = runs.groupBy("doc_id", "digest").agg(
        F.sum("copies").cast("int").alias("copies"), F.max("n_words").alias("n_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("runs")))).alias("runs"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("ids")))))).alias("items"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    covered = F.aggregate("runs", start, lambda acc, r: F.struct(
        (acc.n + F.greatest(r.end - F.greatest(r.begin, acc.reach), F.lit(0))).alias("n"), F.greatest(acc.reach, r.end).alias("reach"))).n
    return (
        gathered.withColumn("n_hit", covered)
        .select("doc_id", "digest", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                ((F.col("n_hit") > 0) & (100 * F.col("n_hit") >= PERCENT * F.col("n_words"))).alias("contaminated"),
                F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
        .drop("copy")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged."""
    # Written first, so that Spark knows its size when it chooses how to join.
    bad = stage(contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias("id"), "digest").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("digest"))
    return rows.join(bad, same, "left_anti").select("row.*")
