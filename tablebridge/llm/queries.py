"""The queries of the operators, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.llm import (
    bpe, decontaminate, licenses, line_crf, merkle, near_copies, pii, quality_rules, search, secrets, syncmers, token_files, toxicity)
from tablebridge.queries.registry import query, table
from tablebridge.session import staging_path


# The words of the texts as the contract writes them; S also holds for lines and rules.
_S = r"[^\x20\x09-\x0D]+"

OP9_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_S}') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS v(k) WHERE r.n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_S}') GROUP BY doc_id),
m AS (SELECT doc_id, t, w, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
      FROM d LEFT JOIN l USING (doc_id) LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR (n_dup_lines >= 3 AND 3 * n_dup_lines > len(string_split(t, chr(10))))
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * len(regexp_extract_all(t, '!')) > n_words
    OR 2 * len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) < n_words) AS kept
FROM b"""


@query("op9_quality_rules", OP9_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


# Words after lower-casing A to Z alone.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TEMPLATE_ROWS = ", ".join(
    f"({i}, '{t.label}', string_split('{t.phrase}', ' '), {t.pairs}, {t.needed}, {str(t.base).lower()})"
    for i, t in enumerate(licenses.TEMPLATES))

OP4_SQL = rf"""
WITH t(number, label, w, pairs, needed, base) AS (VALUES {_TEMPLATE_ROWS}),
tp AS (SELECT number, i - 1 AS place, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT number, w, unnest(range(1, len(w))) AS i FROM t)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
dp AS (SELECT doc_id, i - 1 AS pos, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
v AS (SELECT doc_id, number, pos - place AS diagonal, list(DISTINCT place) AS places, min(pos) AS f, max(pos) + 1 AS l
      FROM dp JOIN tp USING (pair) GROUP BY doc_id, number, diagonal),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w > 2 THEN 1 ELSE 0 END AS new FROM v WINDOW w AS (PARTITION BY doc_id, number ORDER BY diagonal)),
m AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, number ORDER BY diagonal) AS span FROM n),
st AS (SELECT m.*, label, base, pairs, needed, len(list_distinct(flatten(list(places) OVER r))) AS sn, max(l) OVER r - min(f) OVER r AS sl
       FROM m JOIN t USING (number) WINDOW r AS (PARTITION BY doc_id, number, span ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND 4 FOLLOWING)),
q AS (SELECT *, CASE WHEN len(places) = pairs THEN pairs WHEN sn >= needed AND sl >= needed AND sl <= pairs + 4 THEN sn END AS near FROM st),
s AS (SELECT doc_id, label, base, pairs, needed, len(list_distinct(flatten(list(places)))) AS voted, max(l) - min(f) AS length, max(near) AS near,
        count(*) FILTER (base AND len(places) = pairs) AS n_base, min(diagonal) FILTER (base AND len(places) = pairs) AS fw,
        max(diagonal) FILTER (base AND len(places) = pairs) AS lw
      FROM q GROUP BY doc_id, number, span, label, base, pairs, needed),
x AS (SELECT *, voted >= needed AND length >= needed AND length <= pairs + 4 AS merged FROM s),
a AS (SELECT doc_id, sum(n_base) AS n_base, min(fw) AS fw, max(lw) AS lw,
        array_to_string(list_sort(list(DISTINCT label) FILTER (n_base > 0)), ',') AS bl,
        array_to_string(list_sort(list(DISTINCT label) FILTER (n_base > 0 OR ((merged OR near IS NOT NULL) AND NOT base))), ',') AS al,
        max(CASE WHEN n_base > 0 OR merged THEN voted / pairs ELSE coalesce(near / pairs, voted / (2 * pairs)) END) AS score FROM x GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, fw AS first_word, lw AS last_word,
  coalesce(bl, '') AS base_labels, coalesce(al, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN a USING (doc_id)"""


@query("op4_license_scan", OP4_SQL)
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


OP1_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
bn AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM bn)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, g)),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM h GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)"""


@query("op1_decontamination", OP1_SQL)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("digest")


@query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.token_report(spark, path)


OP6_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_S}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * k >= 85 * (ca.n + cb.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, min(b) AS component_id FROM r JOIN d ON d.doc_id = r.a LEFT JOIN c USING (doc_id) GROUP BY doc_id, n"""


@query("op6_jaccard_join", OP6_SQL)
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query("op5_line_crf")
def op5_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.score_quality(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.scan_pii(docs, pii.train(docs))


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan_secrets(docs, secrets.train(docs))


OP11_SQL = r"""
WITH w AS (SELECT rowid AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
n AS (SELECT d, doc_id, len(t) AS n FROM w WHERE len(t) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
p AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM w) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * s.docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM p, s GROUP BY term, s.docs),
i AS (SELECT item, item_id, term, count(*) AS times FROM (
        SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        unnest(t) AS u(term) GROUP BY ALL),
x AS (SELECT item, item_id, d, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * s.docs) // s.words)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN f USING (term) JOIN n USING (d), s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20"""


@query("op11_ranked_search", OP11_SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _crc_row(byte: int) -> int:
    for _ in range(8):
        byte = byte >> 1 ^ 0xEDB88320 * (byte & 1)
    return byte


def _sql_h(columns: dict[str, str]) -> str:
    return "sha256(" + " || ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || {v} END" for c, v in columns.items()) + ")"


def _sql_levels(name: str, levels: int) -> str:
    """The levels of the trees over {name}0(tree, pos, size, digest): each a row for every run of 16."""
    return "".join(f"""
{name}{k} AS (SELECT tree, pos // 16 AS pos, (size + 15) // 16 AS size, list(digest ORDER BY pos) AS run,
  CASE WHEN size = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest FROM {name}{k - 1} GROUP BY tree, pos // 16, size),"""
                   for k in range(1, levels + 1))


def _sql_folds(name: str, leaves: str, levels: int) -> str:
    """{name}f0 and on: the leaves with the siblings so far and the hash that the changed leaf leads to."""
    return f"\n{name}f0 AS (SELECT *, pos AS here, size AS left_over FROM {leaves})," + "".join(f"""
{name}g{k} AS (SELECT f.*, array_to_string(run[1:here % 16], '') AS before, array_to_string(run[here % 16 + 2:], '') AS behind
  FROM {name}f{k - 1} f JOIN {name}{k} n ON n.tree = f.tree AND n.pos = here // 16),
{name}f{k} AS (SELECT * EXCLUDE (here, left_over, fold, proof, before, behind), here // 16 AS here, (left_over + 15) // 16 AS left_over,
  proof || before || behind AS proof, CASE WHEN left_over = 1 THEN fold ELSE sha256(before || fold || behind) END AS fold FROM {name}g{k}),"""
                                                                                                for k in range(1, levels + 1))


_LEAF = {"doc_id": "doc_id", "source": "source", "lang": "lang", "n_chars": "n_chars", "text": "text"}
_TAMPERED = _LEAF | {"text": "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"}
_IN, _OVER = 5, 3  # levels that the SQL spells out: 16 ** 5 documents of a source, 16 ** 3 sources

OP12_SQL = f"""
WITH c AS (SELECT {[_crc_row(b) for b in range(256)]}::BIGINT[] AS row),
h AS (SELECT doc_id, source, {_sql_h(_LEAF)} AS leaf, {_sql_h(_TAMPERED)} AS changed,
  xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: xor(a >> 8, c.row[(xor(a, b) & 255) + 1]))) AS crc FROM documents, c),
l AS (SELECT doc_id, source, leaf, CASE WHEN crc % 5 = 0 THEN changed ELSE leaf END AS fold, '' AS proof,
  coalesce(strlen(source) || ':' || source, '-') AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY source) AS size FROM h),
n0 AS (SELECT tree, pos, size, leaf AS digest FROM l),{_sql_levels("n", _IN)}
t AS (SELECT any_value(source) AS source, tree FROM l GROUP BY tree),
s AS (SELECT tree AS own, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM n{_IN} JOIN t USING (tree)),
o0 AS (SELECT '' AS tree, pos, size, subroot AS digest FROM s),{_sql_levels("o", _OVER)}{_sql_folds("n", "l", _IN)}
u AS (SELECT doc_id, leaf, subroot, fold, proof, '' AS tree, s.pos, s.size FROM nf{_IN} f JOIN s ON s.own = f.tree),{_sql_folds("o", "u", _OVER)}
z AS (SELECT digest AS root FROM o{_OVER})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified FROM of{_OVER}, z"""


@query("op12_merkle_manifest", OP12_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = merkle.leaf([lowered if c == "text" else F.col(c) for c in merkle.COLUMNS])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = merkle.manifest(docs, extra={"tampered": F.when(chosen, tampered)})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return rows.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


@query("op13_syncmers")
def op13_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.neighbour_fingerprints(table(spark, sf_dir, "documents"))
