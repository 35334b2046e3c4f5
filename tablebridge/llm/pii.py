"""Personal data by candidate gradient boosting.

Loose generators propose overlapping spans of four kinds. Every candidate is described by
its format (lengths, digits, groups, checks) and its context (neighbouring characters,
words before it), boosted trees score it, and a threshold for each kind, calibrated for
PRECISION on all documents that the trees did not see, selects what is added. What the strict
base rules find is always kept; an added span never overlaps another span of its kind.

No table labels personal data, so the trees learn from the base rules: in all documents
candidates that a base rule found are positive, those that miss every base span are negative.
Of these a text gives at most PER_TEXT of each kind and class to the fit, copies of it nothing
more, and at most MAX_CANDIDATES are fitted, chosen by hash from all documents with an equal
share for each kind and class and weighted for those left out. Curve and thresholds have no such
bounds: every candidate of a quarter of the texts, chosen by hash and kept from the trees, is
scored and counted. So the method finds what looks the same but stands where the
strict patterns, which never retry, fail: two card numbers with one space between them, an
address with blanks around its at sign.

Places are code points, ends exclusive. A null text is an empty one, without spans. Rows
are searched one by one, so repeated rows and null or repeated ids are unaffected; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.batches import slices, tidy
from tablebridge.llm.boosting import boost, least_threshold, margins, platt, sigmoid
from tablebridge.llm.intervals import Taken
from tablebridge.session import stage

KINDS = ("email", "ip", "card", "phone")
MAX_CANDIDATES = 40_000  # of all documents' that go into the fit
FOLDS = 4  # a text's digest tells its fold; the trees don't see the first
STEPS = 256  # of a margin, by which all held-out candidates are counted
PER_TEXT = 16  # candidates of a kind and class that one text gives to the fit
PRECISION = 0.95
LOWEST = 0.6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits that is no address holds none further on, so only its first digit is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?)[A-Za-z0-9-]{1,63}){1,8}")
_LOOSE_NUMBER = re.compile(r"(?<![0-9])(?:\+|\(\+?)?[0-9](?:[\x20().\-/]{0,2}[0-9])+")
_GROUP = re.compile(r"[0-9]+")
_HINTS = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"), "card": ("card", "visa", "pay", "credit"),
          "phone": ("tel", "phone", "call", "fax", "mobile")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base rules, by kind as listed, then start."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            free = m.end()
        # characters before this sign cannot begin a later match
        free = max(free, at + 1)
        at = text.find("@", free)
    if not _DIGITS.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that could be personal data; they overlap within and across kinds."""
    out = []
    if "@" in text or "(at)" in text or "[at]" in text:
        out += [("email", *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    for m in _LOOSE_NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, m.start(), m.end())]
        for i in range(len(groups)):
            digits = 0
            for j in range(i, len(groups)):
                digits += groups[j][1] - groups[j][0]
                a, b = groups[i][0], groups[j][1]
                if digits > 19:
                    break
                if 13 <= digits:
                    out.append(("card", a, b))
                if j - i == 3 and b - a <= 18:
                    out.append(("ip", a, b))
                if 7 <= digits <= 15 and j > i:
                    while a > 0 and text[a - 1] in "+(":
                        a -= 1
                    out.append(("phone", a, b))
    return list(dict.fromkeys(out))


def describe(text: str, span: tuple[str, int, int]) -> list[float]:
    kind, a, b = span
    own = text[a:b]
    groups = [len(g) for g in _GROUP.findall(own)]
    digits = "".join(c for c in own if "0" <= c <= "9")
    parts = [int(g) if len(g) < 9 else 1 << 30 for g in _GROUP.findall(own)]
    before, after = text[a - 1:a], text[b:b + 1]
    context = text[max(0, a - 24):a].lower()
    return [
        KINDS.index(kind), b - a, len(digits), sum(c.isalpha() for c in own), len(groups), max(groups, default=0), min(groups, default=0),
        own.count("."), own.count("-"), own.count(" "), own.count("(") + own.count(")"), own.count("@"), own[0] == "+", own[0] == "(",
        luhn(digits), max(parts, default=0) <= 255, len(own.rpartition(".")[2]), len(set(digits)), own[0].isdigit() and own[0] == "0",
        0 if not before else 1 if before.isspace() else 2 if before.isdigit() else 3 if before.isalpha() else 4,
        0 if not after else 1 if after.isspace() else 2 if after.isdigit() else 3 if after.isalpha() else 4,
        any(h in context for h in _HINTS[kind]), sum(c.isdigit() for c in context), sum(c.isdigit() for c in text[b:b + 24]),
    ]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _taken(spans: list[tuple[str, int, int]]) -> dict[str, Taken]:
    return {kind: Taken(s[1:] for s in spans if s[0] == kind) for kind in KINDS}


def _place(digest: bytes, span: tuple[str, int, int]) -> int:
    """Where a candidate of the text with this digest stands among all others."""
    return int.from_bytes(hashlib.blake2b(digest + repr(span).encode(), digest_size=8).digest(), signed=True)


def quotas(totals: dict, most: int) -> dict:
    """An equal share of ``most`` for each class; what small classes leave over goes to the larger."""
    out, left = {}, most
    for i, (k, n) in enumerate(sorted(totals.items(), key=lambda x: (x[1], x[0]))):
        out[k] = min(n, left // (len(totals) - i))
        left -= out[k]
    return out


def _sorted_out(text: str) -> Iterator[tuple[tuple[str, int, int], int]]:
    """Candidates with 1 if a base rule found them, 0 if they miss every base span of their kind."""
    base = base_spans(text)
    taken, listed = _taken(base), set(base)
    for span in candidates(text):
        if span in listed or not taken[span[0]].meets(*span[1:]):
            yield span, int(span in listed)


def train(docs: DataFrame) -> tuple | None:
    """(trees, slope, offset, threshold of each kind) from all documents; None if they show no candidates of both sorts."""
    texts = docs.select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                digest = hashlib.md5(text.encode()).digest()
                classes: dict = {}
                for span, y in _sorted_out(text):
                    classes.setdefault((KINDS.index(span[0]), y), []).append((_place(digest, span), span))
                for (kind, y), members in classes.items():
                    rows += [(kind, y, place, digest[0] % FOLDS, [float(y), *describe(text, span)]) for place, span in heapq.nsmallest(PER_TEXT, members)]
            columns = [("kind", pa.int32()), ("y", pa.int32()), ("place", pa.int64()), ("fold", pa.int32()), ("row", pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(columns)})

    # written once, as each kind and class reads it
    found = stage(texts.mapInArrow(tidy(run), "kind int, y int, place bigint, fold int, row array<double>").distinct(), "candidates")
    totals = {(r["kind"], r["y"]): r["count"] for r in found.groupBy("kind", "y").count().collect()}
    if len({y for _, y in totals}) < 2:
        return None
    chosen = []
    for (of_kind, of_y), n in quotas(totals, MAX_CANDIDATES).items():
        least = found.filter((F.col("kind") == of_kind) & (F.col("y") == of_y)).orderBy("place").limit(n).collect()
        chosen += [(r.fold, r.row, totals[of_kind, of_y] / n) for r in least]
    chosen.sort()
    table, weight = np.array([[fold, *row] for fold, row, _ in chosen]), np.array([w for *_, w in chosen])
    seen = table[:, 0] > 0
    held_out = 0 < table[seen, 1].sum() < seen.sum() and not seen.all()
    seen = seen if 0 < table[seen, 1].sum() < seen.sum() else np.ones(len(table), dtype=bool)
    trees = boost(table[seen, 2:], table[seen, 1], weight=weight[seen])
    return trees, *calibrate(sorted(map(tuple, _judged(texts, trees, held_out).collect())))


def _judged(texts: DataFrame, trees: list, held_out: bool) -> DataFrame:
    """Of every candidate of the held-out texts, or of all: kind, step of the margin, how many there are, how many are right.

    A text and its copies count once. There are at most 60 * STEPS steps of a kind, however many candidates.
    """
    shared = texts.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                digest = hashlib.md5(text.encode()).digest()
                if held_out and digest[0] % FOLDS or not (own := list(_sorted_out(text))):
                    continue
                margin = margins(shared.value, np.array([describe(text, span) for span, _ in own], dtype=float))
                steps = np.floor(np.clip(margin, -30, 30) * STEPS).astype(int).tolist()
                counts = Counter((KINDS.index(span[0]), step, y) for (span, y), step in zip(own, steps, strict=True))
                rows += [(digest, *key, n) for key, n in counts.items()]
            columns = [("text", pa.binary()), ("kind", pa.int32()), ("step", pa.int32()), ("y", pa.int32()), ("n", pa.int64())]
            yield pa.RecordBatch.from_pydict({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(columns)})

    counted = texts.mapInArrow(tidy(run), "text binary, kind int, step int, y int, n bigint").distinct()
    return counted.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("right"))


def calibrate(steps: list[tuple[int, int, int, int]]) -> tuple[float, float, list[float]]:
    """Slope, offset and thresholds of all candidates counted by (kind, step, number, right ones); a threshold is the lower edge of a step."""
    kind, step, n, right = (np.array(c, dtype=float) for c in zip(*steps, strict=True))
    y = right / n
    slope, offset = platt((step + 0.5) / STEPS, y, n * min(1.0, MAX_CANDIDATES / n.sum()))
    if slope <= 0:  # trees that rank backwards add nothing
        return slope, offset, [2.0] * len(KINDS)
    p = sigmoid(slope * (step / STEPS) + offset)
    return slope, offset, [least_threshold(p[kind == k], y[kind == k], PRECISION, LOWEST, n[kind == k]) for k in range(len(KINDS))]


def find(text: str, model: tuple | None) -> tuple[list, list]:
    """(base spans, all spans) of a text, by kind as listed, then start."""
    base = base_spans(text)
    listed = set(base)
    proposed = [s for s in candidates(text) if s not in listed] if model else []
    if not proposed:
        return base, base
    trees, slope, offset, thresholds = model
    p = sigmoid(slope * margins(trees, np.array([describe(text, s) for s in proposed], dtype=float)) + offset)
    spans, taken = list(base), _taken(base)
    for i in np.argsort(-p, kind="stable"):
        kind, a, b = proposed[i]
        if p[i] >= thresholds[KINDS.index(kind)] and taken[kind].take(a, b):
            spans.append(proposed[i])
    return base, sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def scan_pii(docs: DataFrame, model: tuple | None) -> DataFrame:
    """Per row: doc_id, the numbers of base spans, base_sha256 and spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some hundred nodes of trees
    kind_of_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [find(t.as_py() or "", shared.value) for t in batch.column("text")]
            columns = {"doc_id": batch.column("doc_id")}
            columns |= {f"n_{k}": pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS}
            columns["base_sha256"] = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            columns["spans"] = pa.array([_joined(spans) for _, spans in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text").mapInArrow(
        tidy(run), f"doc_id {kind_of_id}, {', '.join(f'n_{k} bigint' for k in KINDS)}, base_sha256 string, spans string")
