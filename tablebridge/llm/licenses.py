"""License scans by diagonal voting, built of DataFrame expressions only.

Every rolling pair of words of every text is hashed and joined to the places of the same
pairs in the templates. A hit at text word p and template word q votes for the diagonal
p - q, the word at which the template would start. Votes of a text, template and diagonal
are gathered as a bit per template place, so repeated votes change nothing. A diagonal
with all its bits is an exact occurrence. Neighbouring diagonals (words were inserted or
dropped between them) are merged; the merged span, or a stretch of its diagonals, is accepted
when enough template places voted and the text span is about as long as the template. So
repeated words, which chain many diagonals, hide neither an exact occurrence nor a close one.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A null text has no
words, no labels and score 0. Repeated rows get one result each; rows that share an id but
not the text are judged apart, null ids included; an empty table gives an empty result;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MERGED = 2  # diagonals at most this far apart are one span
SHARE = 0.75  # of a template's pairs that must vote, for templates of LONG pairs and more; all pairs of shorter ones
LONG = 6
MAX_PAIRS = 62  # a bit of a long for each pair of a template


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str
    base: bool = False

    @property
    def pairs(self) -> int:
        return len(self.phrase.split()) - 1

    @property
    def needed(self) -> int:
        return self.pairs if self.pairs < LONG else -int(-SHARE * self.pairs // 1)


TEMPLATES = (
    # The base phrases and their labels.
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    # Wordings of common licenses.
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("gpl", "this work is licensed under the gnu general public license"),
    Template("cc-by", "this work is licensed under a creative commons attribution"),
    Template("public-domain", "this work has been dedicated to the public domain"),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, ascii_uppercase, ascii_lowercase), NON_WORD), "")


def template_places(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """One row per pair of words of a template: its hash, the template's number, the place."""
    rows = []
    for number, t in enumerate(templates):
        w = t.phrase.split()
        if not 1 <= t.pairs <= MAX_PAIRS:
            raise ValueError(f"{t.label}: a template has 2 to {MAX_PAIRS + 1} words")
        rows += [f"('{w[i]}', '{w[i + 1]}', {number}, {i})" for i in range(t.pairs)]
    return docs.sparkSession.sql(
        f"SELECT xxhash64(a, b) AS pair, number, place FROM VALUES {', '.join(rows)} AS t(a, b, number, place)")


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, base places, labels and the best share of a template found."""
    texts = docs.select("doc_id", "text").withColumn("digest", F.xxhash64("text"))
    key = ["doc_id", "digest"]
    pairs = texts.select(*key, words(F.col("text")).alias("w")).select(*key, F.posexplode(F.zip_with(
        "w", F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))), lambda a, b: F.xxhash64(a, b))).alias("at", "pair"))
    # The templates are a fixed list of a few hundred pairs; Spark sees their size and broadcasts them.
    votes = (
        pairs.join(template_places(docs, templates), "pair")
        .groupBy(*key, "number", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.bit_or(F.expr("shiftleft(1L, place)")).alias("bits"), F.min("at").alias("first"), (F.max("at") + 1).alias("last"))
    )
    per_template = Window.partitionBy(*key, "number").orderBy("diagonal")
    stretch = Window.partitionBy(*key, "number", "span").orderBy("diagonal").rangeBetween(0, 2 * MERGED)
    stats = F.array(*[F.struct(F.lit(t.label).alias("label"), F.lit(t.pairs).alias("pairs"), F.lit(t.needed).alias("needed"),
                               F.lit(t.base).alias("base")) for t in templates])

    def close(voted: Column, length: Column) -> Column:
        """Words in another order or scattered over the text span too much or too little for their template."""
        return (voted >= F.col("t.needed")) & (length >= F.col("t.needed")) & (length <= F.col("t.pairs") + 2 * MERGED)

    spans = (
        votes.withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(per_template) > MERGED).cast("int"))
        .withColumn("span", F.sum(F.coalesce("new", F.lit(0))).over(per_template))
        .withColumn("t", F.get(stats, F.col("number")))
        .withColumn("exact", F.col("t.base") & (F.bit_count("bits") == F.col("t.pairs")))
        .withColumn("near", F.bit_count(F.bit_or("bits").over(stretch)))
        .withColumn("near_length", F.max("last").over(stretch) - F.min("first").over(stretch))
        .withColumn("near", F.when(F.bit_count("bits") == F.col("t.pairs"), F.col("t.pairs")).when(close(F.col("near"), F.col("near_length")), F.col("near")))
        .groupBy(*key, "number", "span")
        .agg(F.first("t").alias("t"), F.bit_count(F.bit_or("bits")).alias("voted"), F.min("first").alias("first"), F.max("last").alias("last"),
             F.max("near").alias("near"), F.count_if("exact").alias("n_base"),
             F.min(F.when(F.col("exact"), F.col("diagonal"))).alias("first_word"),
             F.max(F.when(F.col("exact"), F.col("diagonal"))).alias("last_word"))
    )
    merged = close(F.col("voted"), F.col("last") - F.col("first"))
    verified = merged | F.col("near").isNotNull()
    found = spans.select(
        *key, F.lit(0).alias("copies"), F.lit(None).cast("long").alias("n_words"), "n_base", "first_word", "last_word",
        F.when(F.col("n_base") > 0, F.col("t.label")).alias("base_label"),
        F.when((F.col("n_base") > 0) | (verified & ~F.col("t.base")), F.col("t.label")).alias("label"),
        F.when((F.col("n_base") > 0) | merged, F.col("voted") / F.col("t.pairs")).otherwise(
            F.coalesce(F.col("near") / F.col("t.pairs"), F.col("voted") / (2 * F.col("t.pairs")))).alias("score"))
    nothing = texts.select(
        *key, F.lit(1).alias("copies"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")), F.lit(0)).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("int").alias("first_word"), F.lit(None).cast("int").alias("last_word"),
        F.lit(None).cast("string").alias("base_label"), F.lit(None).cast("string").alias("label"), F.lit(0.0).alias("score"))
    return (
        nothing.unionByName(found).groupBy(*key)
        .agg(F.sum("copies").cast("int").alias("copies"), F.max("n_words").alias("n_words"), F.sum("n_base").alias("n_base"),
             F.min("first_word").cast("long").alias("first_word"), F.max("last_word").cast("long").alias("last_word"),
             F.array_join(F.sort_array(F.collect_set("base_label")), ",").alias("base_labels"),
             F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))
