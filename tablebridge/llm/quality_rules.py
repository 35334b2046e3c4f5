"""Quality rules as a short-circuit cascade, built of DataFrame expressions only.

Each rule rejects or passes a text. On a sample every rule is timed and its share of
rejected texts measured; the rules are then chained by rejections per second, so that
a text which a cheap and severe rule rejects never pays for the dear ones. The order
changes the work and the name of the rejecting rule, never which texts are kept.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text counts as an empty one: no words, no
lines, rejected by ``too_short``. Rows are judged one by one, so repeated rows and
repeated or null ids get equal verdicts, an empty table gives an empty table, and
columns besides ``text`` pass through whatever their names are.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.session import stage

SAMPLE_ROWS = 2_000  # rows that costs and selectivities are estimated on
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")).cast("long")


def symbols(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(SYMBOLS)).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, also where lambdas refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeated_words(found: Column) -> Column:
    """Words inside windows of three words that the text holds twice or more.

    Windows are hashed and sorted with their place, so equal ones become neighbours.
    """
    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))

    def twice(s: Column) -> Column:
        # get() gives null beyond either end, and a null never equals
        def same(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(s, i - 1).h == x.h, F.lit(False)) | F.coalesce(F.get(s, i + 1).h == x.h, F.lit(False))

        return F.flatten(F.transform(F.filter(s, same), lambda x: F.array(x.i, x.i + 1, x.i + 2)))

    inside = F.size(F.array_distinct(let(F.sort_array(let(found, windows)), twice)))
    return F.when(F.size(found) < 4, F.lit(0)).otherwise(inside).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the text and its words to a boolean that is never null."""

    name: str
    rejects: Callable[[Column, Column], Column]


BASE = (
    Rule("too_short", lambda text, found: F.size(found) < MIN_WORDS),
    Rule("repeats_itself", lambda text, found: 100 * repeated_words(found) > MAX_REPEATED_PERCENT * F.size(found)),
)

OWN = (
    Rule("symbols", lambda text, found: 10 * symbols(text) > F.size(found)),
    Rule("duplicate_lines", lambda text, found: let(duplicate_lines(text), lambda n: (n >= 3) & (
        3 * n > F.size(F.split(F.coalesce(text, F.lit("")), "\n"))))),
    Rule("word_length", lambda text, found: (word_chars(text) < 2 * F.size(found)) | (word_chars(text) > 15 * F.size(found))),
    Rule("exclamations", lambda text, found: 5 * F.regexp_count(F.coalesce(text, F.lit("")), F.lit("!")) > F.size(found)),
    Rule("no_letters", lambda text, found: 2 * F.size(F.filter(found, lambda w: w.rlike(r"\p{L}"))) < F.size(found)),
)

RULES = BASE + OWN


def with_words(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` packed into ``row``, with their words; no name can clash."""
    return docs.select(F.struct("*").alias("row"), words(F.col("text")).alias("found"))


def order_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second on a sample of about ``sample_rows`` rows.

    The sample serves nothing but the order. Rules that reject nothing come last, the
    cheapest first; an empty table keeps the given order.
    """
    total = docs.count()
    if not total:
        return list(rules)
    texts = docs.select("text")
    chosen = texts if total <= sample_rows else texts.sample(fraction=sample_rows / total, seed=9)
    sample = stage(chosen, "rules")
    timed = []
    for rule in rules:
        judged = with_words(sample).select(rule.rejects(F.col("row.text"), F.col("found")).alias("out"))
        start = time.perf_counter()
        rejected = judged.agg(F.count_if("out")).first()[0]
        timed.append((rejected / (spent := time.perf_counter() - start), -spent, rule))
    return [rule for *_, rule in sorted(timed, key=lambda x: x[:2], reverse=True)]


def rejected_by(text: Column, found: Column, rules: Sequence[Rule]) -> Column:
    """The name of the first rule that rejects, else null; later rules aren't evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(text, found), F.lit(rule.name)).otherwise(verdict)
    return verdict


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, columns unchanged."""
    ordered = order_rules(docs, rules, sample_rows)
    # The words are bound inside the verdict: a filter on a column of words would be worked out anew for every rule.
    text = F.col("text")
    return docs.filter(let(words(text), lambda found: rejected_by(text, found, ordered)).isNull())


def quality_report(docs: DataFrame, own: Sequence[Rule] = OWN, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: doc_id, the base measures, base_failed, kept and the rejecting rule.

    The base measures are wanted of every text, so only the rules in ``own`` are ordered
    and cut short, behind the base verdict.
    """
    ordered = order_rules(docs, own, sample_rows)
    measured = with_words(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "found",
        F.size("found").cast("long").alias("n_words"),
        word_chars(F.col("row.text")).alias("word_chars"),
        symbols(F.col("row.text")).alias("n_symbols"),
        duplicate_lines(F.col("row.text")).alias("n_dup_lines"),
        repeated_words(F.col("found")).alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    rule = F.when(failed, F.lit("base")).otherwise(rejected_by(F.col("text"), F.col("found"), ordered))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), rule.isNull().alias("kept"))
