"""Rows that every operator must take, and made-up prose."""

import random

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

#: Extra columns bear names that operators use inside.
SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("own_row", StringType()),
    StructField("text_print", IntegerType()), StructField("lines", StringType()), StructField("a b", StringType()),
    StructField("node", LongType()), StructField("row", StringType()), StructField("n", LongType()),
])


def prose(seed: int, words: int, vocabulary: int = 400) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}{draw.choice(['', '', ',', '.'])}" for _ in range(words)]


def messy(spark, texts=()):
    """Null ids and texts, empty and blank texts, a very long one, repeated rows, and `texts` by id."""
    long = " ".join(prose(7, 60_000, 5000))
    rows = [(None, None), (None, ""), (None, "a null id  here"), (1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (5, long),
            (6, "same row\nsame row"), (6, "same row\nsame row"), (6, "same id, other text"), (7, "é ß\u00a0漢字 😀\n"),
            *((100 + i, t) for i, t in enumerate(texts))]
    return spark.createDataFrame([(i, t, "x", 1, None, "y", i, "z", None) for i, t in rows], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def split(text):
    return (text or "").encode().split()
