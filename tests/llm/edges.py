"""Documents with nulls, empty and very long texts, repeated rows and ids, and columns whose names operators use."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

NAMES = ("lang", "source", "row", "key", "n", "comp", "digest", "found", "id", "ids", "score", "copies")
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("n_chars", LongType()),
                     *[StructField(n, StringType()) for n in NAMES]])


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghiklmnoprstuvwz", k=r.randint(2, 9))) for _ in range(words))


LONG = prose(1, 30_000)
PLAIN = prose(2, 80)
ROWS = [(1, None), (2, ""), (3, LONG), (4, PLAIN), (4, PLAIN), (5, "one two"), (5, "three four five"), (None, PLAIN), (None, None),
        (6, " \n\t "), (7, PLAIN + " end"), (8, "Ünï çødé İ K 漢字 🙂 " * 3)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None if t is None else len(t), *[n if i != 4 else None for n in NAMES]) for i, t in rows], SCHEMA)


def edge_docs(spark):
    return frame(spark, ROWS)


def no_docs(spark):
    return frame(spark, [])


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
