"""Operators that judge each text by itself, on edge cases and against plain Python."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from edges import LONG, PLAIN, ROWS, edge_docs, frame, no_docs, prose, rows_of
from oracle import compare
from tablebridge.llm import boosting, bpe, char_cnn, intervals, licenses, pii, quality_rules, secrets, simple8b, token_files
from tablebridge.llm import queries as llm_queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- quality rules ---

def test_quality_measures_of_edge_rows(spark):
    out = quality_rules.quality_report(edge_docs(spark))
    assert out.count() == len(ROWS)
    by_id = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert (by_id[1].n_words, by_id[1].base_failed, by_id[1].kept) == (0, True, False)
    assert by_id[6].n_words == 0 and by_id[6].n_dup_lines == 0
    assert by_id[3].n_words == 30_000 and by_id[3].kept
    assert by_id[4].kept and by_id[8].word_chars == len("ÜnïçødéİK漢字🙂" * 3)
    assert quality_rules.quality_report(no_docs(spark)).count() == 0


def test_repeated_words_and_lines(spark):
    text = "a b c x a b c\na b c x a b c\n\nlast line"
    row = quality_rules.quality_report(frame(spark, [(1, text)])).first()
    # windows abc, bcx, cxa, xab occur twice or more; all words but the last two are inside one
    assert (row.n_repeat_words, row.n_dup_lines, row.n_words) == (14, 1, 16)


def test_cascade_keeps_rows_and_columns(spark):
    docs = edge_docs(spark)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "n") == sorted([(3, "n"), (4, None), (4, None), (None, "n"), (7, "n")], key=repr)
    assert quality_rules.keep_good(no_docs(spark)).count() == 0


def test_order_of_rules_does_not_change_verdicts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ways = [quality_rules.with_words(docs).filter(quality_rules.rejected_by(
        quality_rules.F.col("row.text"), quality_rules.F.col("found"), rules).isNull()).select("row.doc_id") for rules in
        (quality_rules.RULES, quality_rules.RULES[::-1])]
    assert rows_of(ways[0], "doc_id") == rows_of(ways[1], "doc_id") == rows_of(quality_rules.keep_good(docs), "doc_id")


# --- licenses ---

def test_licenses(spark):
    bsd = licenses.TEMPLATES[8].phrase
    dropped = " ".join(w for w in bsd.split() if w != "binary")
    scattered = " filler words between ".join(bsd.split())
    rows = [(1, "Licensed under CC BY-NC 4.0."), (2, "x All Rights reserved; all rights reserved"), (3, "so " + dropped), (4, scattered),
            (5, "general public"), (6, None), (6, None), (7, "GENERAL\nPUBLIC license")]
    out = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert (out[1].base_labels, out[1].labels, out[1].first_word, out[1].n_words) == ("cc-by", "cc-by,cc-by-nc", 2, 7)
    assert (out[2].n_base, out[2].first_word, out[2].last_word, out[2].score) == (2, 1, 4, 1.0)
    assert (out[3].n_base, out[3].labels) == (0, "bsd") and 0.7 < out[3].score < 1
    assert out[4].labels == "" and out[5].labels == "" and 0 < out[5].score <= 0.5
    assert (out[6].n_words, out[6].score, out[6].first_word) == (0, 0.0, None)
    assert out[7].base_labels == "gpl"
    assert licenses.scan_licenses(frame(spark, rows)).count() == len(rows)


def test_repeated_words_hide_no_license(spark):
    bsd = licenses.TEMPLATES[8].phrase
    close = "source and binary " * 9 + " ".join(w for w in bsd.split() if w != "modification")
    rows = [(1, "CC BY, CC BY, CC BY, CC BY-NC"), (2, "cc by cc by cc by cc by sa"), (3, "source and binary " * 9 + bsd), (4, close),
            (5, "cc by cc by cc by cc by and nc")]
    out = {r.doc_id: r for r in licenses.scan_licenses(frame(spark, rows)).collect()}
    assert [out[i].labels for i in range(1, 6)] == ["cc-by,cc-by-nc", "cc-by,cc-by-sa", "bsd", "bsd", "cc-by"]
    assert out[1].score == out[3].score == 1.0 and 0.75 <= out[4].score < 1


def test_licenses_of_repetitive_texts_against_sql(spark):
    """Random texts of a few template words chain many diagonals; operator and SQL judge them alike."""
    rng = random.Random(5)
    kinds = [["CC", "by", "nc", "sa", "-"], ["released", "under", "the", "MIT", "license", "x"], ["all", "rights", "reserved", "general", "public", "license"],
             "redistribution and use in source and binary forms with or without modification are permitted".split()]
    rows = [(0, "CC BY, CC BY, CC BY, CC BY-NC"), (1, "cc by cc by cc by sa"), (2, "a\u212b \u212aelvin cc BY"), (3, None), (4, "")]
    for i in range(5, 400):
        kind = rng.choice(kinds)
        at = rng.randint(0, len(kind) - 1)
        walk = [kind[(at + k + (rng.random() < 0.2)) % len(kind)] for k in range(rng.randint(1, 30))]
        rows.append((i, " ".join(rng.choice(kind) if rng.random() < 0.25 else w for w in walk)))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert compare(licenses.scan_licenses(df), con, llm_queries.OP4_SQL) == ""


def test_licenses_edges(spark):
    assert licenses.scan_licenses(edge_docs(spark)).count() == len(ROWS)
    assert licenses.scan_licenses(no_docs(spark)).count() == 0


# --- token files ---

@pytest.fixture(scope="module")
def byte_level():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("high", [0, 1, 30, 50_000, 1 << 61])
@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 1_000])
def test_simple8b_round_trip(n, high):
    values = np.random.default_rng(n).integers(0, high + 1, n).astype(np.uint64)
    values[::7] = np.uint64(2**64 - 1) if high > 1 << 60 else values[::7]
    out, places = simple8b.from_block(simple8b.to_block(values, np.array([0, n // 2, n])))
    assert (out == values).all() and places.tolist() == [0, n // 2, n]


def test_small_values_share_words():
    assert len(simple8b.pack(np.zeros(600))[0]) == 10
    with pytest.raises(ValueError):
        simple8b.from_block(b"\0" * 64)


def test_pieces_equal_the_library(byte_level):
    r = random.Random(5)
    parts = ["a", "Bc", "é", "ÿ", "×", " ", "  ", "\n", "\x1c", "\x85", "'s", "'", "12", "½", "!", "<|endoftext|>", "<|", "漢", "\x00", " w", "İ"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 20))) for _ in range(3_000)] + [PLAIN, LONG]
    bpe_ = token_files.ByteBpe(bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, n = bpe_.encode(data, offsets)
    expected = [byte_level.encode(t, add_special_tokens=False).ids for t in texts]
    assert n.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e]


def test_token_files(spark, tmp_path, byte_level):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(edge_docs(spark).repartition(3), public_tokenizers.path("byte_bpe_50k.json"), path)
    ids = {t: byte_level.encode(t or "", add_special_tokens=False).ids + [0] for _, t in ROWS}
    report = token_files.token_report(spark, path).collect()
    crc = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in report) == sorted((i or 0, len(ids[t]), crc(ids[t])) for i, t in ROWS)
    ordered = sorted(report, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
    keys = [r.doc_id for r in ordered]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    read = token_files.read_token_files(spark, path).filter("doc_id = 3").first()
    assert list(read.ids) == ids[LONG]


def test_no_token_files(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(no_docs(spark), public_tokenizers.path("byte_bpe_50k.json"), path)
    assert token_files.token_report(spark, path).count() == 0


# --- BPE ---

@pytest.fixture(scope="module")
def word_level():
    path = public_tokenizers.path("word_bpe_49k.json")
    return tokenizers.Tokenizer.from_file(path), bpe.WordBpe(bpe.read_tokenizer(path))


def test_bpe_equals_the_library(word_level, sf, spark):
    library, ours = word_level
    r = random.Random(1)
    parts = ["a", "B", "Σ", "ς", "é", "́", " ", "\x1c", "\x85", " ", "'s", "'ll", "٣", "½", "<|endoftext|>", "<|startoftext|>", "<|", "İ", "漢", "🙂", "!", "ǅ", "ſ"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 25))) for _ in range(3_000)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == ids
        assert ours.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_of_every_code_point(word_level):
    library, ours = word_level
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}b {chr(c)}1" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    differing = [i for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)) if e.ids != ours.encode(texts[i])]
    assert not differing


def test_bpe_of_long_pieces(word_level):
    library, ours = word_level
    text = "ab" * 20_000 + " " + "é漢" * 3_000
    assert ours.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert max(map(len, ours.known), default=0) <= bpe.CACHED_CHARS


def test_bpe_rows(spark, word_level):
    library, _ = word_level
    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.round_trip(edge_docs(spark), path, with_ids=True)
    expected = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)), ids))
    assert rows_of(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids") == sorted(expected, key=repr)
    assert rows_of(bpe.encode_column(edge_docs(spark), path), "doc_id", "ids") == sorted([(e[0], e[4]) for e in expected], key=repr)
    assert bpe.round_trip(no_docs(spark), path).count() == 0


# --- personal data ---

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_pii(text):
    def good(kind, own):
        digits = re.sub("[^0-9]", "", own)
        if kind == "card":
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
        return kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in own.split("."))) or (kind == "phone" and 9 <= len(digits) <= 15)

    return [(k, *m.span()) for k, p in PII.items() for m in re.finditer(p, text) if good(k, m[0])]


def test_base_pii_against_the_plain_patterns():
    r = random.Random(3)
    parts = [*"a1@.-+ (0)9%", "1.2.3.4", "+1 (017) 555-7713", "4111111111111111", "a@b.c", "é", "256.", "00"]
    for _ in range(20_000):
        text = "".join(r.choices(parts, k=r.randint(0, 14)))
        assert pii.base_spans(text) == brute_pii(text)


def test_pii_adds_what_strict_patterns_drop(spark, sf):
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.1/documents.parquet")
    model = pii.train(docs)
    two = "Pay with 4111111111111111 5500005555555559 or so"
    out = pii.scan_pii(frame(spark, [(1, two), (2, "write to jo.doe@mail.example.com now"), (3, None), (4, PLAIN)]), model)
    spans = {r.doc_id: r for r in out.collect()}
    assert spans[1].n_card == 0 and spans[1].spans == "card:9:25,card:26:42"
    assert spans[2].spans == "email:9:32" and spans[2].base_sha256 == sha("email:9:32")
    assert spans[3].spans == spans[4].spans == "" and spans[3].base_sha256 == sha("")


@pytest.mark.parametrize("kind,number", [("phone", "00 33 1 23 45 67 89"), ("card", "41.11.11.11.11.11.11.11"), ("card", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1")])
def test_numbers_of_many_groups_are_proposed_whole(kind, number):
    assert (kind, 5, 5 + len(number)) in pii.candidates(f"dial {number} today")


def test_pii_learns_behind_texts_full_of_numbers(spark, sf):
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.1/documents.parquet").select("text")
    numbers = [" ".join(str(r.randint(10**6, 10**7 - 1)) for _ in range(8_000)) for r in map(random.Random, range(3))]
    assert sum(len(pii.candidates(t)) for t in numbers) > pii.MAX_CANDIDATES
    model = pii.train(spark.createDataFrame([(t,) for t in numbers], "text string").coalesce(1).union(docs))
    assert model is not None and max(model[3]) <= 1
    two = "Pay with 4111111111111111 5500005555555559 or so"
    assert ("card", 9, 25) in pii.find(two, model)[1] and pii.find(two, model)[0] == []


def test_pii_chooses_from_every_kind_and_class(spark, sf, monkeypatch):
    monkeypatch.setattr(pii, "MAX_CANDIDATES", 400)
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.1/documents.parquet").select("text")
    assert pii.train(docs.orderBy("text")) == pii.train(docs.orderBy(F.col("text").desc())) is not None
    assert pii.quotas({"a": 3, "b": 90, "c": 50}, 63) == {"a": 3, "b": 30, "c": 30}
    assert pii.quotas({"a": 3, "b": 90}, 400) == {"a": 3, "b": 90}


def test_pii_learns_from_all_documents(spark, sf):
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.01/documents.parquet").select("text")
    assert pii.train(docs.union(spark.range(60_000).selectExpr("'' AS text"))) == pii.train(docs) is not None


def test_pii_thresholds_count_every_held_out_candidate(spark, sf):
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.01/documents.parquet").select("text")
    numbers = [" ".join(str(r.randint(10**6, 10**7 - 1)) for _ in range(100)) for r in map(random.Random, range(40))]
    docs = docs.union(spark.createDataFrame([(t,) for t in numbers * 2], "text string"))
    trees, slope, offset, thresholds = pii.train(docs)
    counts = {}
    for text in {r.text or "" for r in docs.collect()}:
        own = list(pii._sorted_out(text)) if hashlib.md5(text.encode()).digest()[0] % 4 == 0 else []
        for span, y in own:
            margin = boosting.margins(trees, np.array([pii.describe(text, span)], dtype=float))[0]
            n = counts.setdefault((pii.KINDS.index(span[0]), int(np.floor(margin * pii.STEPS))), [0, 0])
            n[0], n[1] = n[0] + 1, n[1] + y
    assert sum(n for n, _ in counts.values()) > 40 * pii.PER_TEXT
    assert sorted(map(tuple, pii._judged(docs, trees, True).collect())) == sorted((*k, *n) for k, n in counts.items())
    assert pii.calibrate(sorted((*k, *n) for k, n in counts.items())) == (slope, offset, thresholds)


def test_thresholds_count_what_was_left_out():
    p, y = np.array([0.9, 0.8, 0.7]), np.array([1.0, 1.0, 0.0])
    assert boosting.least_threshold(p, y, 0.6, 0.5) == 0.7
    assert boosting.least_threshold(p, y, 0.6, 0.5, np.array([1.0, 1.0, 5.0])) == 0.8


def test_pii_edges(spark):
    assert pii.train(no_docs(spark)) is None
    assert pii.scan_pii(edge_docs(spark), None).count() == len(ROWS)
    assert pii.scan_pii(no_docs(spark), None).count() == 0


# --- secrets ---

# The contract's pattern with the case of each letter spelled out.
ASSIGN = re.compile("(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in
                                   ("password", "passwd", "secret", "token", "api_?key")) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_secrets(text):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_base_secrets_against_the_plain_patterns():
    r = random.Random(4)
    parts = ["token", "Password", "api_key", "APIKEY", "ſecret", "toKen", " ", "=", ":", "'", '"', "abcdef0123456789", "AKIA", "ABCDEF0123456", "g", "é"]
    for _ in range(20_000):
        text = "".join(r.choices(parts, k=r.randint(0, 10)))
        assert secrets.base_spans(text) == brute_secrets(text)


@pytest.fixture(scope="module")
def secret_model(spark, sf):
    return secrets.train(spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.1/documents.parquet"))


def test_secrets_found_and_clean_text_left_alone(spark, secret_model):
    key = hashlib.sha1(b"x").hexdigest()
    rows = [(1, f'my token = "{key}" here'), (2, PLAIN), (3, None), (4, f"bearer {key.upper()}"), (5, LONG)]
    out = {r.doc_id: r for r in secrets.scan_secrets(frame(spark, rows), secret_model).collect()}
    assert (out[1].n_assign, out[1].n_hex, out[1].n_access) == (1, 1, 0)
    assert out[1].base_sha256 == sha(secrets.joined(brute_secrets(rows[0][1])))
    assert out[2].spans == out[3].spans == out[5].spans == ""
    assert secrets.scan_secrets(edge_docs(spark), None).count() == len(ROWS)
    assert secrets.train(no_docs(spark)) is None


def test_taken_spans_by_brute_force():
    r = random.Random(9)
    for _ in range(300):
        spans = [(a, a + r.randint(1, 9)) for a in (r.randint(0, 60) for _ in range(r.randint(0, 6)))]
        taken = intervals.Taken(spans)
        for _ in range(20):
            a = r.randint(0, 60)
            b = a + r.randint(1, 9)
            meets = any(x < b and a < y for x, y in spans)
            assert taken.meets(a, b) == meets and taken.take(a, b) != meets
            if not meets:
                spans.append((a, b))


def test_many_secrets_in_one_text(spark):
    """The work grows with the findings of a text, not with their square."""
    def seconds(n):
        text = " ".join(f"token = {hashlib.sha1(str(i).encode()).hexdigest()} and bearer K{i}x{'abcdefghij' * 2} mail{i}@example.org" for i in range(n))
        start = time.perf_counter()
        secrets.find_all([text], None)
        secrets.candidates(text)
        taken = intervals.Taken(s[1:] for s in secrets.base_spans(text))
        assert sum(not taken.meets(*s) for s in secrets.candidates(text)) == n
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) < 12 * seconds(4_000) + 0.5


def keyed_docs(spark):
    """Listed secrets in most documents, and as many behind a name that the base rules do not list."""
    r = random.Random(6)
    key = lambda: "".join(r.choices("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789", k=30)) + "7x"
    listed = (lambda: f'token = "{key()}"', lambda: f"password: {key()}", lambda: f"see AKIA{key().upper()} for", lambda: f"x {sha(key())} y")
    rows = [(prose(100 + i, 30) + f" {listed[i % 4]()} " + prose(900 + i, 30) + f" abcdefghijklmno bearer {key()} end",) for i in range(400)]
    return spark.createDataFrame(rows, "text string"), [f"{prose(i, 3)} bearer {key()} end" for i in range(50)]


def test_secrets_outside_the_base_rules_are_added(spark):
    docs, texts = keyed_docs(spark)
    *found, (_, plain) = secrets.find_all([*texts, PLAIN], secrets.train(docs))
    whole = [[("other", t.index("bearer ") + 7, len(t) - 4)] for t in texts]
    assert all(base == [] and spans in ([], w) for (base, spans), w in zip(found, whole, strict=True)) and plain == []
    assert sum(spans == w for (_, spans), w in zip(found, whole, strict=True)) > 25


def test_the_threshold_keeps_the_recall(spark, monkeypatch):
    monkeypatch.setattr(char_cnn, "fit", lambda x, y, split: char_cnn.start())  # a network that tells little
    docs, _ = keyed_docs(spark)
    net, slope, offset, threshold = secrets.train(docs)
    seen = [secrets.window(t, m.start(2), m.end(2)) for t, in docs.collect() for m in ASSIGN.finditer(t)]
    p = boosting.sigmoid(slope * char_cnn.margins(net, secrets.seen_by_net(seen), secrets.BEFORE) + offset)
    assert len(p) == 200 and (p < 0.9).any() and (p >= threshold).mean() > 0.95


@pytest.mark.parametrize("step", [secrets.train, lambda docs: corpus_pipeline.without_secrets(docs.sparkSession, docs, "")])
def test_every_document_teaches_the_secret_scan(spark, monkeypatch, step):
    """All of 20,400 documents, and all their candidates, not some of them."""
    monkeypatch.setattr(secrets, "MAX_PER_CLASS", 40)
    monkeypatch.setattr(secrets, "SHARD", 4_000)
    calibrated, rounds, real, go_on = [], [], secrets.calibrate, secrets.next_round
    monkeypatch.setattr(secrets, "calibrate", lambda steps: calibrated.append(steps) or real(steps))
    monkeypatch.setattr(secrets, "next_round", lambda found, net, shards: rounds.append((found.count(), shards)) or go_on(found, net, shards))
    texts = [f"{i} ordinarywords{' token = ' + hashlib.md5(str(i).encode()).hexdigest() if i % 200 == 0 else ''}" for i in range(20_400)]
    step(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    # a word of each text, and a value in each 200th
    held = [i for i, t in enumerate(texts) if hashlib.md5(t.encode()).digest()[0] % 4 == 0]
    findings = sum(i % 200 == 0 for i in held)
    assert sum(n for _, n, _ in calibrated[0]) == len(held) + findings and sum(right for *_, right in calibrated[0]) == findings
    learned = 20_400 + 102 - len(held) - findings
    assert rounds == [(learned, -(-learned // 4_000))] * secrets.ROUNDS


def test_a_round_takes_the_mean_of_all_shards(spark, monkeypatch):
    monkeypatch.setattr(char_cnn, "descend", lambda net, x, y, split, epochs, rate: [p + y.sum() / len(y) for p in net])
    rows = [(i % 5, int(i % 9 == 0), f"seen {i}") for i in range(500)]
    net = secrets.next_round(spark.createDataFrame(rows, "fold int, y int, seen string"), char_cnn.start(), 7)
    share = sum(y for _, y, _ in rows) / len(rows)
    assert all(np.allclose(a, b + share) and a.shape == b.shape for a, b in zip(net, char_cnn.start(), strict=True))


def test_the_network_is_the_same_however_the_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(secrets, "MAX_PER_CLASS", 100)
    monkeypatch.setattr(secrets, "SHARD", 300)
    docs, _ = keyed_docs(spark)
    one, other = secrets.train(docs.repartition(1)), secrets.train(docs.repartition(7))
    assert one[1:] == other[1:] and all((a == b).all() for a, b in zip(one[0], other[0], strict=True))


@pytest.mark.parametrize("slope", [1, -1])
def test_the_threshold_by_counted_steps(slope):
    r = np.random.default_rng(3)
    y = (np.arange(3_000) % 3 == 0).astype(int)
    margin = slope * np.clip(r.normal(4 * y - 2, 2), -30, 30)
    steps = np.floor(margin * secrets.STEPS).astype(int)
    got = secrets.calibrate([(int(s), int((steps == s).sum()), int(y[steps == s].sum())) for s in np.unique(steps)])
    p = boosting.sigmoid(got[0] * margin + got[1])
    exact = np.sort(p[y == 1])[int((1 - secrets.RECALL) * y.sum())]
    assert got[0] * slope > 0 and (p[y == 1] >= got[2]).mean() >= secrets.RECALL and exact - 0.01 < got[2] <= exact


def test_redaction(spark, secret_model):
    key = hashlib.sha1(b"y").hexdigest()
    docs = frame(spark, [(1, f'my token = "{key}" here'), (2, PLAIN), (3, None), (4, "")])
    out = {r.doc_id: r for r in secrets.redact(docs, secret_model).collect()}
    assert out[1].text == 'my [SECRET]" here' and out[1].n_chars == len(out[1].text)
    assert out[2].text == PLAIN and out[3].text is None and out[4].text == ""
    assert secrets.redact(docs, secret_model).columns == docs.columns


def test_prose_is_stable():
    assert prose(2, 80) == PLAIN
