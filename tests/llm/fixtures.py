"""Small tables with everything that may go wrong in a column."""

from __future__ import annotations

import random

from pyspark.sql import types as T

LONG = " ".join(f"w{i % 997} x{i % 89}" for i in range(40_000))
WORDS = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha") for b in ("la", "me", "ni", "po", "ru", "st", "va")]

# columns whose names clash with the operators' own
EXTRA = [("score", T.DoubleType()), ("size", T.LongType()), ("key", T.StringType()), ("rid", T.LongType()),
         ("copies", T.StringType()), ("length", T.LongType()), ("_key", T.LongType()), ("k", T.StringType()),
         ("held_out", T.StringType()), ("bands", T.LongType()), ("class_id", T.LongType()), ("spans", T.StringType())]
DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())])
WIDE_SCHEMA = T.StructType([*DOC_SCHEMA, *[T.StructField(n, t) for n, t in EXTRA]])


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empties, ties, repeated rows, a long text, odd characters."""
    rng = random.Random(5)
    base = sentence(rng, 60)
    rows = [
        (1, base, "en", "a", len(base)), (1, base, "en", "a", len(base)), (2, base, "en", "b", len(base)),
        (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \t\n\x0b ", "en", "b", 5), (None, "lost id", "en", "a", 7),
        (None, None, None, None, None), (6, LONG, "en", "a", len(LONG)), (7, base + " tail", "en", "c", None),
        (8, "naïve \U0001F600 <|endoftext|> <|im_end|> Ünïcödé İ\x00\x1c", "fr", "ü", 40), (8, "other text", "en", "c", 10),
        (9, "password = abcdef123 and AKIA" + "A1" * 10 + " " + "0f" * 15, "en", "b", 60), (-5, "x", "en", "", 1),
    ]
    return rows + [(100 + i, sentence(rng, rng.randint(1, 120)), "en", f"s{i % 4}", 1) for i in range(40)]


def odd_docs(spark, wide: bool = True):
    if not wide:
        return spark.createDataFrame(odd_rows(), DOC_SCHEMA)
    return spark.createDataFrame([(*r, *[None] * len(EXTRA)) for r in odd_rows()], WIDE_SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], WIDE_SCHEMA)
