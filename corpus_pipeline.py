"""A corpus made ready for training: five stages, each a function of (spark, docs, sf_dir).

Each stage's rows are written to the shared folder before the next one reads them; those that come
from Python are written by the stage itself, in short batches. All but the last return the columns of ``docs``, whatever their names are. Null, empty and wordless texts
are rejected by the quality rules, so later stages see none of them in a run; given such rows,
they keep them: a null text has no words, no shared shingles, no benchmark passage and no
secret, and stays null. Rows with a null id that pass the rules all stay, as no least id can
stand for their group. Of rows with equal ids in a group of near copies all stay or go together.
Repeated rows are treated alike, and an empty table stays empty through all stages. Near copies
are told by WORDS words and PERCENT per cent, the rule for stages on word shingles; the query of
the operator alone keeps its own four words and 85 per cent.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablebridge.llm import batches, bpe, decontaminate, near_copies, quality_rules, secrets
from tablebridge.queries.registry import query, table
from tablebridge.session import stage

TOKENIZER = "word_bpe_49k.json"
WORDS, PERCENT = 5, 80  # of near copies


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies."""
    return near_copies.drop_near_copies(docs, WORDS, PERCENT)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than the allowed share of benchmark text."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return batches.stage(secrets.redact(docs, secrets.train(docs)), "secret-scans")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the decoded text, and the ids."""
    return batches.stage(bpe.round_trip(docs, public_tokenizers.path(TOKENIZER), with_ids=True, lasting=False), "tokens")


STAGES = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", not_in_benchmark),
    ("secret scans", without_secrets),
    ("BPE encoding and decoding", tokens),
]

ORACLE_SQL = None  # a trained network finds the secrets; tests hold the stages against brute force


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = step(spark, docs, sf_dir)
        if step not in (without_secrets, tokens):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
