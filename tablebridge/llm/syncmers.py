"""Document fingerprints of closed syncmers.

Of all substrings of K code points those are kept whose smallest inner substring of S code
points (by a hash) stands at the beginning or the end. Whether one is kept depends on its
own characters alone, so a passage has the same anchors wherever it stands, and of every
K - S + 1 consecutive substrings at least one is kept. A fingerprint lists the anchors of
the whole text with their places. Two fingerprints are compared by place: equal anchors are
paired in order of appearance, and the longest run of pairs that ascends in both texts counts.

As text a fingerprint is the base64 form of five bytes for each anchor: its hash (four bytes,
little-endian) and the distance from the anchor before it (for the first, from the text's
beginning). A text without any such anchor (shorter than K, or a little longer) has one that
stands for the whole text; an empty text has none.

Each document is compared with the one after it, so neighbours have to meet. Ids are dealt
into ranges whose bounds come from ids and text hashes alone, texts are shuffled once by
range, and the first document of each range also goes to the range before it. The bounds are
one key for each shuffle partition.

Nulls and ties: a null text counts as an empty one and a null id comes first; equal ids stand
in the order of their texts' hashes. Rows that are equal in both get a result each; if there
are so many that they would fill a range, one of them is shuffled with their number. After the
last document comes the first, so a lone document is its own neighbour. An empty table gives
an empty result, and other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.batches import small_batches
from tablebridge.llm.words import mixed
from tablebridge.session import stage

K = 48
S = 16  # K - S and S are powers of two times S: windows are built by doubling
_PRIME = 0x9E3779B97F4A7C15 | 1
_ANCHOR = np.dtype([("hash", "<u4"), ("gap", "u1")])


class Fingerprint(NamedTuple):
    hash: np.ndarray  # uint32, in order of appearance
    at: np.ndarray  # code points before the anchor


def _joined(left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Hashes of substrings of two neighbouring parts, the right one of ``length`` code points."""
    return left[:len(right)] * np.uint64(pow(_PRIME, length, 1 << 64)) + right


def fingerprint(text: str) -> Fingerprint:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(points):
        return Fingerprint(np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64))
    if len(points) >= K:
        inner, length = mixed(points + np.uint64(1)), 1
        while length < S:
            inner, length = _joined(inner, inner[length:], length), 2 * length
        whole, length = inner, S
        while length < K - S:
            whole, length = _joined(whole, whole[length:], length), 2 * length
        whole = _joined(whole, inner[K - S:], S)
        rank = mixed(inner)
        least, width = rank, 1
        while width < K - S:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[:len(whole)], rank[K - S:])
        at = np.flatnonzero((rank[:len(whole)] == least) | (rank[K - S:] == least))
        if len(at):
            return Fingerprint((mixed(whole[at]) >> np.uint64(32)).astype(np.uint32), at)
    digest = hashlib.blake2b(points.tobytes(), digest_size=4).digest()
    return Fingerprint(np.frombuffer(digest, dtype="<u4").astype(np.uint32), np.zeros(1, dtype=np.int64))


def to_text(print_: Fingerprint) -> str:
    out = np.empty(len(print_.hash), dtype=_ANCHOR)
    out["hash"], out["gap"] = print_.hash, np.diff(print_.at, prepend=0)
    return base64.b64encode(out.tobytes()).decode()


def from_text(text: str) -> Fingerprint:
    anchors = np.frombuffer(base64.b64decode(text), dtype=_ANCHOR)
    return Fingerprint(anchors["hash"].astype(np.uint32), np.cumsum(anchors["gap"], dtype=np.int64))


def _named(hashes: np.ndarray) -> np.ndarray:
    """Each anchor's hash with the number of equal ones before it: no two names are equal."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.arange(len(hashes))
    out = np.empty(len(hashes), dtype=np.uint64)
    out[order] = ordered.astype(np.uint64) << np.uint64(32) | (place - np.maximum.accumulate(np.where(new, place, 0))).astype(np.uint64)
    return out


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Twice the anchors that both have in the same order, over all anchors; 1 if both have none."""
    if np.array_equal(a.hash, b.hash):
        return 1.0
    if not len(a.hash) or not len(b.hash):
        return 0.0
    _, mine, theirs = np.intersect1d(_named(a.hash), _named(b.hash), assume_unique=True, return_indices=True)
    other = theirs[np.argsort(mine)]
    if len(other) < 2 or (other[1:] > other[:-1]).all():
        common = len(other)
    else:
        ends: list[int] = []  # the least end of an ascending run of each length
        for x in other.tolist():
            k = bisect_left(ends, x)
            ends[k:k + 1] = [x]
        common = len(ends)
    return 2 * common / (len(a.hash) + len(b.hash))


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by as much of the next text's beginning."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _key(doc_id: Any, digest: int) -> tuple:
    return doc_id is not None, doc_id if doc_id is not None else 0, digest


def _neighbours(docs: DataFrame) -> tuple[DataFrame, int]:
    """(head, doc_id, digest, text, copies), each range in a partition of its own, sorted; and the number of ranges.

    ``head`` marks the first document of the next range, which stands last.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.xxhash64("text"))
    counts = stage(keyed.groupBy("doc_id", "digest").agg(F.count("*").alias("n")), "keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    # At most as many as there are ranges, each with more rows than a range should hold.
    hot = {_key(r.doc_id, r.digest): r.n for r in counts.filter(F.col("n") > max(1, -(-total // ranges))).collect()}
    firsts = counts.repartitionByRange(ranges, "doc_id", "digest").groupBy(F.spark_partition_id()).agg(F.min(F.struct("doc_id", "digest")).alias("k")).collect()
    bounds = sorted(_key(*r.k) for r in firsts)  # one for each range
    rows = keyed.withColumn("copies", F.lit(1).cast("long"))
    if hot:
        listed = spark.createDataFrame([(k[1] if k[0] else None, k[2], n) for k, n in hot.items()],
                                       counts.select("doc_id", "digest", F.col("n").alias("copies")).schema)
        same = keyed.doc_id.eqNullSafe(listed.doc_id) & (keyed.digest == listed.digest)
        alone = keyed.join(listed, same, "left_anti").withColumn("copies", F.lit(1).cast("long"))
        one = keyed.join(listed, same, "left_semi").groupBy("doc_id", "digest").agg(F.first("text").alias("text"))
        one = one.join(listed.toDF("i", "d", "copies"), one.doc_id.eqNullSafe(F.col("i")) & (one.digest == F.col("d")))
        rows = alone.select("doc_id", "text", "digest", "copies").union(one.select("doc_id", "text", "digest", "copies"))
    shared = spark.sparkContext.broadcast(bounds)

    @F.pandas_udf("array<int>")
    def places(keys: pd.DataFrame) -> pd.Series:
        edges = shared.value
        last = len(edges) - 1
        starts = set(edges)
        out = []
        for missing, doc_id, digest in keys.itertuples(index=False, name=None):
            key = (False, 0, digest) if missing else (True, doc_id, digest)
            at = bisect_right(edges, key) - 1
            out.append([at, at - 1 if at else last] if key in starts else [at])
        return pd.Series(out)

    # A null id would turn whole numbers into floats on their way to pandas.
    filled = F.coalesce("doc_id", F.lit(0 if docs.schema["doc_id"].dataType.typeName() != "string" else "").cast(docs.schema["doc_id"].dataType))
    placed = rows.withColumn("places", places(F.struct(F.col("doc_id").isNull().alias("missing"), filled.alias("doc_id"), "digest")))
    dealt = placed.select("doc_id", "digest", "text", "copies", F.posexplode("places").alias("head", "range"))
    return dealt.repartitionById(ranges, "range").sortWithinPartitions("head", "doc_id", "digest").select("head", "doc_id", "text", "copies"), ranges


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None  # the document that waits for the next one
        for batch in batches:
            out: list[tuple] = []

            def finish(text: str, print_: Fingerprint, copies: int) -> None:
                changed = edited(own[1], text)
                other = fingerprint(changed)
                out.append((own[0], len(own[1]), hashlib.sha256(changed.encode()).hexdigest(), to_text(own[2]), to_text(other),
                            likeness(own[2], other), likeness(own[2], print_), copies))

            for head, doc_id, text, copies in zip(*(batch.column(c).to_pylist() for c in ("head", "doc_id", "text", "copies")), strict=True):
                print_ = own[2] if own is not None and own[1] == text else fingerprint(text)
                if own is not None:
                    finish(text, print_, 1)
                own = None if head else (doc_id, text, print_)
                if copies > 1 and not head:
                    finish(text, print_, copies - 1)  # all but the last of equal rows come before one of them
            columns = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([
                pa.array(columns[0], batch.schema.field("doc_id").type), pa.array(columns[1], pa.int64()), *[pa.array(c, pa.string()) for c in columns[2:5]],
                *[pa.array(c, pa.float64()) for c in columns[5:7]], pa.array(columns[7], pa.int64())],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "copies"])

    rows, _ = _neighbours(docs)
    with small_batches(docs.sparkSession):
        found = rows.mapInArrow(compare, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                         "near_edited double, near_next double, copies bigint")
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")
