"""Documents with the awkward cases that every operator has to define."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, part long, spans string, id string, key string"


def documents(spark, rows):
    """rows: (doc_id, text); further columns carry names that operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "r", 1, "x", "y", "z") for i, t in rows], SCHEMA)


def awkward(words):
    """Nulls, empty and blank texts, repeated rows, a null id, one long text and texts without ASCII."""
    long = " ".join(words[i % len(words)] + str(i % 97) for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "Only"), (5, "two Words"), (5, "two Words"), (None, "a row without an id"),
        (6, long), (7, "日本語 のテキスト é É ñ 🙂"), (8, "the same text of several words " * 9), (9, "the same text of several words " * 9),
        (10, "x" * 3000), (11, "a<|endoftext|>b  c\r\nd"),
    ]


WORDS = "the of and a to in is was he for it with as his on be at by had not are but from or have".split()


def empty(spark):
    return spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
