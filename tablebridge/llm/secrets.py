"""Secret scans by a character convolutional network.

Every long token that mixes letters and digits, and every value behind a telling name, is a
candidate. A network sees the characters before it, its own and those behind it. What the
strict base rules find is always kept; a candidate outside those spans is added as kind
``other`` when its calibrated probability reaches the threshold that keeps RECALL of the
labelled findings.

Labelled findings are what base rules find in all documents;
candidates that miss every base span are the other class, save values with digits behind a
telling name: they may be secrets that no rule lists, and belong to neither class. Long words
(WORDS_PER_TEXT of each text, by a hash) belong to the other class too. All of them are used,
equal ones once: those of three quarters of the texts train the network, the others calibrate.
The network starts from at most MAX_PER_CLASS candidates of a class, by a hash. If there are more, every
task goes on from it over a SHARD of all of them, and the mean of what the tasks reach goes on, ROUNDS times.

Places are code points, ends exclusive. A null text is an empty one, without spans. Rows
are searched one by one, so repeated rows and null or repeated ids are unaffected; an empty
table gives an empty result. ``redact`` passes other columns through whatever their names are.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm import char_cnn
from tablebridge.llm.batches import slices, tidy
from tablebridge.llm.boosting import platt, sigmoid
from tablebridge.llm.intervals import Taken
from tablebridge.session import stage

KINDS = ("assign", "access", "hex", "other")
MAX_PER_CLASS = 2_000  # candidates that the network starts from
SHARD = 16_384  # candidates that a task goes on with, on average
ROUNDS = 2  # over all candidates
RATE = 1e-3  # of a step in a round
UNIT = 2 ** 32  # by which a weight is counted where means are formed
STEPS = 256  # of a margin, by which all held-out candidates are counted
WORDS_PER_TEXT = 2  # ordinary words of a text that train or calibrate
RECALL = 0.98
BEFORE, OWN, AFTER = 20, 44, 8  # characters that the network sees; a longer candidate shows both its ends
MARK = "[SECRET]"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_NAMED = re.compile(r"""(?:pwd|auth|credentials?|private_?key|bearer|client_?secret|access_?key)["']?\x20*+[:=]?\x20*+["']?([A-Za-z0-9+/_.=-]{12,})""",
                    re.IGNORECASE | re.ASCII)
_LONG_WORD = re.compile(r"[^\W\d_]{12,}")
_TELLING = ("pwd", "auth", "credential", "private", "bearer", "client", "access")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base rules by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of tokens that could be secrets."""
    out = [m.span() for m in _TOKEN.finditer(text) if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])]
    low = text.lower()
    if any(n in low for n in _TELLING):
        out += [m.span(1) for m in _NAMED.finditer(text)]
    return sorted(set(out))


def window(text: str, a: int, b: int) -> str:
    """What the network sees of a candidate, always of the same length."""
    own = text[a:b] if b - a <= OWN else text[a:a + OWN // 2] + text[b - OWN // 2:b]
    return text[max(0, a - BEFORE):a].rjust(BEFORE, "\0") + own.ljust(OWN, "\0") + text[b:b + AFTER].ljust(AFTER, "\0")


def seen_by_net(texts: list[str]) -> np.ndarray:
    return char_cnn.encode(texts, BEFORE + OWN + AFTER)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def labelled(docs: DataFrame) -> DataFrame:
    """fold, y and what the network sees of every labelled candidate of ``docs``, once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                fold = hashlib.md5(text.encode()).digest()[0] % 4
                unsure = {s[1:] for s in base} | {m.span(1) for m in _NAMED.finditer(text) if any(c.isdigit() for c in m[1])}
                values = {(m.start(2), m.end(2)) for m in _ASSIGN.finditer(text)} if base else set()
                found = {(a, b) for k, a, b in base if k != "assign"} | {(a, b) for a, b in values if b - a >= 8}
                rows += [(fold, 1, window(text, a, b)) for a, b in found]
                taken = Taken(unsure)
                rows += [(fold, 0, window(text, a, b)) for a, b in candidates(text) if not taken.meets(a, b)]
                # ordinary words are no secrets either, whatever stands before them
                words = (m.span() for m in _LONG_WORD.finditer(text) if not taken.meets(*m.span()))
                rows += [(fold, 0, window(text, a, b)) for a, b in heapq.nsmallest(WORDS_PER_TEXT, words, key=lambda s: (zlib.crc32(text[s[0]:s[1]].encode()), s))]
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array([r[0] for r in rows], pa.int32()), "y": pa.array([r[1] for r in rows], pa.int32()), "seen": pa.array([r[2] for r in rows], pa.string())})

    return docs.select("text").mapInArrow(tidy(run), "fold int, y int, seen string").distinct()


def train(docs: DataFrame) -> tuple | None:
    """(network, slope, offset, threshold) from all documents; None if they lack one of the classes."""
    found = stage(labelled(docs), "candidates")  # written once, as every round reads them
    totals = {(r.held, r.y): r["count"] for r in found.groupBy((F.col("fold") == 0).alias("held"), "y").count().collect()}
    if len({y for _, y in totals}) < 2:
        return None
    apart = len(totals) == 4  # both classes train and calibrate
    learn, rest = (found.filter("fold > 0"), found.filter("fold = 0")) if apart else (found, found)
    first = [r for y in (0, 1) for r in learn.filter(F.col("y") == y).orderBy(F.xxhash64("seen"), "seen", "fold").limit(MAX_PER_CLASS).collect()]
    net = char_cnn.fit(seen_by_net([r.seen for r in first]), np.array([r.y for r in first]), BEFORE)
    n = sum(k for (held, _), k in totals.items() if not (apart and held))
    for _ in range(ROUNDS if n > len(first) else 0):  # else it has seen all of them
        net = next_round(learn, net, -(-n // SHARD))
    return net, *calibrate(sorted(map(tuple, judged(rest, net).collect())))


def next_round(found: DataFrame, net: list[np.ndarray], shards: int) -> list[np.ndarray]:
    """The network after all candidates: the mean of those that go on from it over one of the ``shards`` each.

    Weights are summed as whole multiples of 1 / UNIT, so the sum is the same in any order, and only the mean comes to the driver.
    """
    shared = found.sparkSession.sparkContext.broadcast(net)

    def run(shard: pa.Table) -> pa.Table:
        rows = sorted(zip(*(shard.column(c).to_pylist() for c in ("seen", "fold", "y")), strict=True))
        new = char_cnn.descend(shared.value, seen_by_net([r[0] for r in rows]), np.array([r[2] for r in rows]), BEFORE, epochs=1, rate=RATE)
        units = np.rint(np.concatenate([p.ravel() for p in new]) * UNIT).astype(np.int64)
        return pa.table({"n": pa.array([len(rows)], pa.int64()), "net": pa.array([units], pa.list_(pa.int64()))})

    dealt = found.withColumn("shard", F.pmod(F.xxhash64("seen"), F.lit(shards)))
    parts = dealt.groupBy("shard").applyInArrow(run, "n bigint, net array<bigint>").select("n", F.posexplode("net").alias("at", "units"))
    sums = parts.groupBy("at").agg(F.sum(F.col("units").cast("decimal(20,0)") * F.col("n").cast("decimal(18,0)")).alias("units"), F.sum("n").alias("n"))
    mean = np.array([int(r.units) / r.n / UNIT for r in sorted(sums.collect(), key=lambda r: r["at"])])
    cuts = np.cumsum([p.size for p in net])[:-1]
    return [part.reshape(p.shape) for part, p in zip(np.split(mean, cuts), net, strict=True)]


def judged(found: DataFrame, net: list[np.ndarray]) -> DataFrame:
    """step of the margin, how many candidates reach it, how many of them are findings: at most 60 * STEPS + 1 rows."""
    shared = found.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            margin = char_cnn.margins(shared.value, seen_by_net(batch.column("seen").to_pylist()), BEFORE)
            step = np.floor(np.clip(margin, -30, 30) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"step": pa.array(step, pa.int32()), "y": batch.column("y")})

    counted = found.select("seen", "y").mapInArrow(tidy(run), "step int, y int")
    return counted.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("right"))


def calibrate(steps: list[tuple[int, int, int]]) -> tuple[float, float, float]:
    """Slope, offset and threshold of all candidates counted by (step, number, findings); the threshold is the lesser edge of a step."""
    step, n, right = (np.array(c, dtype=float) for c in zip(*steps, strict=True))
    slope, offset = platt((step + 0.5) / STEPS, right / n, n * min(1.0, 2 * MAX_PER_CLASS / n.sum()))
    p = sigmoid(slope * (step + (slope < 0)) / STEPS + offset)
    order = np.argsort(p, kind="stable")
    at = np.searchsorted(np.cumsum(right[order]), int((1 - RECALL) * right.sum()), side="right")
    return slope, offset, float(p[order][at])


def find_all(texts: list[str], model: tuple | None) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, by start, then kind."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    net, slope, offset, threshold = model
    taken = [Taken(s[1:] for s in b) for b in base]
    todo = [(i, a, b) for i, t in enumerate(texts) for a, b in candidates(t) if not taken[i].meets(a, b)]
    p = sigmoid(slope * char_cnn.margins(net, seen_by_net([window(texts[i], a, b) for i, a, b in todo]), BEFORE) + offset)
    out = [(b, list(b)) for b in base]
    for (i, a, b), score in sorted(zip(todo, p, strict=True), key=lambda c: -c[1]):
        if score >= threshold and taken[i].take(a, b):
            out[i][1].append(("other", a, b))
    return [(b, sorted(s, key=lambda s: (s[1], KINDS.index(s[0])))) for b, s in out]


def scan_secrets(docs: DataFrame, model: tuple | None) -> DataFrame:
    """Per row: doc_id, the numbers of base spans, base_sha256 and spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand weights
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = find_all([t.as_py() or "" for t in batch.column("text")], shared.value)
            columns = {"doc_id": batch.column("doc_id")}
            columns |= {f"n_{k}": pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS[:3]}
            columns["base_sha256"] = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            columns["spans"] = pa.array([joined(spans) for _, spans in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(
        tidy(run), f"doc_id {kind}, {', '.join(f'n_{k} bigint' for k in KINDS[:3])}, base_sha256 string, spans string")


def hidden(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by MARK."""
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], MARK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: tuple | None) -> DataFrame:
    """The rows of ``docs`` with secrets in ``text`` replaced by MARK and n_chars, if there is one, counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            found = find_all([t or "" for t in texts], shared.value)
            new = [None if t is None else hidden(t, spans) if spans else t for t, (_, spans) in zip(texts, found, strict=True)]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["text"] = pa.array(new, batch.schema.field("text").type)
            if "n_chars" in columns:
                counted = [n if x is t else len(x) for n, x, t in zip(columns["n_chars"].to_pylist(), new, texts, strict=True)]
                columns["n_chars"] = pa.array(counted, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(tidy(run), docs.schema)
