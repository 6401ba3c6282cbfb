"""Rows that every operator must take: nulls, empties, ties, repeats, long texts, clashing extra columns."""

from __future__ import annotations

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix potions near old stone bridges".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)] + ("" if i % 5 else str(seed * i % 97)) for i in range(n))


LONG = prose(3, 60_000)
DOCS = [
    (1, prose(1, 120), "en", "a", 1, 5.0),
    (2, prose(1, 120), "en", "a", 2, None),  # the text of 1
    (3, None, "en", None, None, 1.0),
    (4, "", None, "b", 0, 1.0),
    (5, LONG, "en", "b", 3, 1.0),
    (6, "  \t\n\v ", "en", "b", 3, 1.0),
    (7, "!!! ??? 123", None, "b", 3, 1.0),
    (7, "!!! ??? 123", None, "b", 3, 1.0),  # a repeated row
    (8, "Éric's l'été 日本語 \U0001f600  don't they're", "fr", "b", 3, 1.0),
    (None, "no key at all", "en", "b", 3, 1.0),
]
SCHEMA = "doc_id long, text string, lang string, source string, kept int, quality double"


def documents(spark):
    """With columns named like results of operators."""
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


def empty(spark, schema: str = SCHEMA):
    return spark.createDataFrame([], schema)
