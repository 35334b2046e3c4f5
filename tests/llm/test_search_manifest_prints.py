"""Ranked search, manifest and fingerprints on edge cases and by brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from edges import LONG, PLAIN, ROWS, edge_docs, frame, no_docs, prose, rows_of
from tablebridge.llm import merkle, search, syncmers
from tablebridge.llm.queries import op11_ranked_search, op12_merkle_manifest, op13_syncmers


# --- ranked search ---

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k=20):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, t in held:
            m = 75 + 25 * len(t) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(x, 0) + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 12 * m))
                        for x in terms(text) if x in t)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def search_docs():
    r = random.Random(11)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(300)]
    docs = [(i, " ".join(r.choices(common, k=r.randint(1, 30)) + r.choices(rare, k=r.randint(0, 4)))) for i in range(900)]
    items = [(i, " ".join(r.choices(common, k=3) + r.choices(rare, k=3))) for i in range(15)]
    items += [(1, "C1 c1 c2"), (1, "C1 c1 c2"), (None, "r1 r2"), (20, None), (21, "-- !"), (22, "unseen"), (23, "é c3")]
    return docs + [(5, docs[5][1]), (None, docs[6][1]), (None, None), (901, "É é")], items


@pytest.mark.parametrize("lot,span,short,block", [(8192, 128, 64, 4 << 20), (100, 16, 8, 4 << 20), (64, 8, 0, 60)])
def test_search_by_brute_force(spark, monkeypatch, lot, span, short, block):
    docs, items = search_docs()
    for name, value in (("LOT", lot), ("RANGE", span), ("SHORT", short), ("BLOCK_BYTES", block)):
        monkeypatch.setattr(search, name, value)
    queries = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    out = search.search(frame(spark, docs).repartition(3), queries)
    assert rows_of(out, "item_id", "rank", "doc_id", "score") == brute_search(docs, items)


def test_search_skips_ranges_and_loses_none():
    r = np.random.default_rng(4)
    size, vocabulary = 4096, 40
    own = [np.unique(r.integers(0, vocabulary, r.integers(1, 12))) for _ in range(size)]
    times = [r.integers(1, 9, len(x)) for x in own]
    weights = r.integers(1, 9000, vocabulary)
    n = np.array([x.sum() for x in times])
    lot = search.Lot(n, np.array([len(x) for x in own]), np.concatenate(own), np.concatenate(times), weights, size, int(n.sum()))
    wanted, repeats = np.array([1, 5, 9]), np.array([2, 1, 1])
    best = search.Best(20)
    first = search.rank_lot(lot, np.arange(size), wanted, repeats, best)
    m = 75 + 25 * n * size // int(n.sum())
    scores = np.array([sum(int(weights[t]) * int(c) * (10**9 * int(f) // (1000 * int(f) + 12 * int(m[i])))
                           for t, c in zip(wanted, repeats, strict=True) for u, f in zip(own[i], times[i], strict=True) if u == t) for i in range(size)])
    order = np.lexsort((np.arange(size), -scores))[:20]
    assert best.doc_id.tolist() == order.tolist() and best.score.tolist() == scores[order].tolist()
    assert 0 < first <= lot.ranges
    best.least = 10**15
    assert search.rank_lot(lot, np.arange(size), wanted, repeats, best) == 0  # nothing can reach the bar: all ranges are skipped


def test_search_edges(spark):
    items = spark.createDataFrame([(1, PLAIN), (None, LONG), (2, None)], "item_id long, text string")
    docs = edge_docs(spark)
    out = search.search(docs, items)
    assert rows_of(out, "item_id", "rank", "doc_id", "score") == brute_search([r[:2] for r in ROWS], [(1, PLAIN), (None, LONG), (2, None)])
    assert search.search(no_docs(spark), items).count() == 0
    assert search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


# --- manifest ---

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_tree(leaves):
    """The root and each leaf's (left, right) siblings by level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = place // 16 * 16
            paths[k].append(("".join(nodes[run:place]), "".join(nodes[place + 1:run + 16])))
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at = [place // 16 for place in at]
    return nodes[0], paths


def brute_manifest(rows):
    """Rows (doc_id, source, lang, n_chars, text) to those of the query."""
    groups = {}
    for row in rows:
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), row[4]) if row[4] is not None else None
        own = h(*map(enc, row))
        changed = h(*map(enc, (*row[:4], lowered))) if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 else own
        groups.setdefault(row[1], []).append(((row[0] is not None, row[0] or 0), own, row[0], changed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[1] for x in sorted(groups[s])]) for s in names}
    root, tops = brute_tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        for (_, own, i, folded), path in zip(sorted(groups[s]), trees[s][1], strict=True):
            for left, right in path + top:
                folded = h(left, folded, right)
            out.append((i, own, trees[s][0], root, h(*[x + y for x, y in path + top]), folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("sources", [[None], ["b"], [None, "a", "é", "", "z", "Z"], [f"s{i}" for i in range(40)]])
def test_manifest_by_brute_force(spark, tmp_path, sources):
    r = random.Random(len(sources))
    rows = [(i, r.choice(sources[:1] * len(sources) + sources), r.choice((None, "en", "dé")), r.choice((None, i)), r.choice((None, "", "AbC é", f"text {i}")))
            for i in range(420)]
    rows += [(None, sources[0], None, None, None)] * 2 + [rows[7]] * 40 + [(7, sources[0], "x", 1, "other")]
    own = "doc_id long, source string, lang string, n_chars long, text string, tree string, at string, node string, digest string"
    spark.createDataFrame([(*x, "t", "a", "n", "d") for x in rows], own).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(op12_merkle_manifest(spark, str(tmp_path)), *COLUMNS) == brute_manifest(rows)


def test_manifest_edges(spark, tmp_path):
    edge_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(x) for x in edge_docs(spark).select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert rows_of(op12_merkle_manifest(spark, str(tmp_path)), *COLUMNS) == brute_manifest(rows)
    assert merkle.manifest(no_docs(spark)).count() == 0
    one = merkle.manifest(frame(spark, [(1, "Ab")])).first()
    assert one.leaf == one.subroot == one.root and one.path == []


# --- fingerprints ---

def brute_anchors(text):
    """Places of closed syncmers by the definition, with the module's order of inner substrings."""
    points = np.array([ord(c) for c in text], dtype=np.uint64)
    value = [int(x) for x in syncmers.mixed(points + np.uint64(1))]

    def part(i, n):
        if n == 1:
            return value[i]
        return (part(i, n // 2) * pow(syncmers._PRIME, n // 2, 1 << 64) + part(i + n // 2, n // 2)) % (1 << 64)

    inner = [part(i, syncmers.S) for i in range(len(text) - syncmers.S + 1)]
    rank = [int(x) for x in syncmers.mixed(np.array(inner, dtype=np.uint64))] if inner else []
    wide = syncmers.K - syncmers.S + 1
    return [i for i in range(len(text) - syncmers.K + 1) if min(rank[i:i + wide]) in (rank[i], rank[i + wide - 1])]


def test_anchors_by_definition():
    for k in range(12):
        text = prose(k, 5 + 12 * k) + " 漢字🙂é" * (k % 3)
        found = syncmers.fingerprint(text)
        expected = brute_anchors(text)
        assert found.at.tolist() == (expected or [0])
        back = syncmers.from_text(syncmers.to_text(found))
        assert back.hash.tolist() == found.hash.tolist() and back.at.tolist() == found.at.tolist()
    at = syncmers.fingerprint(LONG).at
    assert np.diff(at, prepend=0).max() <= syncmers.K - syncmers.S + 1  # no gap: every window of substrings has an anchor
    inside = LONG[1000:1400]
    assert set(syncmers.fingerprint(inside).hash) <= set(syncmers.fingerprint(LONG).hash)  # free of context
    assert syncmers.to_text(syncmers.fingerprint("")) == ""


def brute_likeness(a, b):
    x, y = syncmers.fingerprint(a).hash.tolist(), syncmers.fingerprint(b).hash.tolist()
    if x == y:
        return 1.0
    seen = {}
    names = [[], []]
    for side, values in enumerate((x, y)):
        seen.clear()
        for v in values:
            names[side].append((v, seen.get(v, 0)))
            seen[v] = seen.get(v, 0) + 1
    place = {v: k for k, v in enumerate(names[1])}
    runs = []
    for v in names[0]:
        if v in place:
            runs.append(1 + max((n for n, p in zip(runs, ends, strict=True) if p < place[v]), default=0) if runs else 1)
            ends = [*ends, place[v]] if len(runs) > 1 else [place[v]]
    return 2 * max(runs, default=0) / (len(x) + len(y)) if x and y else 0.0


def brute_prints(docs, spark):
    """Rows of the query by one sorted list; equal ids stand in the order of Spark's hash of the text."""
    hashed = spark.createDataFrame([(k, t or "") for k, (_, t) in enumerate(docs)], "k int, text string").selectExpr("k", "xxhash64(text) AS h").collect()
    order = [k for _, k in sorted(((docs[r.k][0] is not None, docs[r.k][0] or 0, r.h), r.k) for r in hashed)]
    out = []
    for place, k in enumerate(order):
        (i, text), follow = docs[k], docs[order[(place + 1) % len(order)]][1] or ""
        text = text or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + follow[:half]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), syncmers.to_text(syncmers.fingerprint(text)),
                    syncmers.to_text(syncmers.fingerprint(changed)), brute_likeness(text, changed), brute_likeness(text, follow)))
    return sorted(out, key=repr)


PRINTS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@pytest.mark.parametrize("partitions", ["8", "1", "40"])
def test_prints_by_brute_force(spark, partitions):
    r = random.Random(13)
    base = [prose(200 + k, r.choice((0, 1, 6, 30, 90))) for k in range(25)]
    docs = [(r.randint(0, 60), base[k % 25] + ("" if r.random() < 0.5 else f" tail {k}")) for k in range(80)]
    docs += [(61, base[3] + " " + base[4]), (62, base[4] + " " + base[3]), (63, None), (63, ""), (None, None), (None, base[5])]
    docs += [(9, base[7])] * 60  # more equal rows than a range should hold
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = rows_of(syncmers.neighbour_fingerprints(frame(spark, docs).repartition(5)), *PRINTS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == brute_prints(docs, spark)


def test_prints_edges(spark):
    assert rows_of(syncmers.neighbour_fingerprints(edge_docs(spark)), *PRINTS) == brute_prints([r[:2] for r in ROWS], spark)
    assert syncmers.neighbour_fingerprints(no_docs(spark)).count() == 0
    lone = syncmers.neighbour_fingerprints(frame(spark, [(3, PLAIN)])).first()
    assert lone.near_next == 1.0 and 0 < lone.near_edited <= 1
    assert syncmers.neighbour_fingerprints(frame(spark, [(3, None)])).first().near_next == 1.0


def test_queries_over_the_given_tables(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows_of(op11_ranked_search(spark, sf), "item_id", "rank", "doc_id", "score") == brute_search(docs, items)
    rows = rows_of(op13_syncmers(spark, sf), *PRINTS)
    assert len(rows) == len(docs) and {x[0]: x[2] for x in rows} == {x[0]: x[2] for x in brute_prints(docs, spark)}
