"""Bounded samples of labelled documents, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.session import stage

FOLDS = 5
MAX_BYTES = 64 << 20  # of a sample's texts together


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is a multiple of FOLDS; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, column: str, rows: int, most_bytes: int = MAX_BYTES) -> DataFrame:
    """doc_id, text and y of about ``rows`` labelled documents that are not held out, one for each id.

    Ids are chosen by a hash, with the share that leaves ``rows`` of them. Null labels are left
    out; of several labels of one id the largest counts, of several texts the one whose hash is
    least. Texts are taken in the order of their ids' hashes while they make at most
    ``most_bytes`` together; one that would exceed them is passed over.
    """
    usable = labels.select("doc_id", F.col(column).alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL").filter(~held_out(F.col("doc_id")))
    ids = usable.groupBy("doc_id").agg(F.max("y").alias("y"))
    total = ids.count()
    below = min((1 << 63) - 1, -(1 << 63) + (rows << 64) // max(1, total))
    # About `rows` ids, written so that Spark knows how few they are when it chooses how to join.
    chosen = stage(ids.filter(F.xxhash64("doc_id") <= F.lit(below).cast("long")).coalesce(1), "chosen")
    sample = stage(docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "y").agg(
        F.min_by("text", F.struct(F.col("text").isNull(), F.xxhash64("text"))).alias("text")), "labelled")
    sizes = sample.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    held, dropped = 0, []
    for doc_id, n in sizes:
        if held + n > most_bytes:
            dropped.append(doc_id)
        else:
            held += n
    return sample.filter(~F.col("doc_id").isin(dropped)) if dropped else sample
