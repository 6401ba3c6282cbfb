"""Columns that depend on the values: one-hot encoding and exploded lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _categories(values: DataFrame) -> list[str]:
    """The distinct values; they become columns, so their number is that of the wanted columns."""
    return sorted(r[0] for r in values.distinct().collect())


def categories(df: DataFrame, tokens: str) -> list[str]:
    """The distinct non-empty tokens of an array column."""
    found = df.select(F.explode(tokens).alias("t")).where("t is not null and t <> ''")
    return _categories(found)


def one_hot_list(
    df: DataFrame,
    tokens: str,
    prefix: str,
    known: Sequence[str] | None = None,
) -> DataFrame:
    """One boolean ``<prefix>_<token>`` per token of an array column."""
    known = categories(df, tokens) if known is None else known
    return df.withColumns(
        {f"{prefix}_{c}": F.coalesce(F.array_contains(tokens, c), F.lit(False)) for c in known}
    )


def one_hot(
    df: DataFrame,
    column: str,
    known: Sequence | None = None,
) -> DataFrame:
    """One boolean ``<column>_<value>`` per value; null sets none."""
    if known is None:
        known = _categories(df.where(F.col(column).isNotNull()).select(column))
    return df.withColumns({f"{column}_{c}": F.col(column).eqNullSafe(F.lit(c)) for c in known})


def token_counts(df: DataFrame, tokens: str, out: str = "token") -> DataFrame:
    """How many rows hold each token of an array column."""
    return df.select(F.explode(tokens).alias(out)).groupBy(out).agg(F.count("*").alias("n"))


def group_tokens(
    df: DataFrame, key: str, tokens: str, prefix: str, known: Sequence[str]
) -> DataFrame:
    """Per key, whether any of its rows holds each token."""
    flags = one_hot_list(df, tokens, prefix, known)
    return flags.groupBy(key).agg(
        *[F.max(f"{prefix}_{c}").alias(f"{prefix}_{c}") for c in known]
    )
