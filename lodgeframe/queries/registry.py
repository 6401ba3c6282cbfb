"""Registered queries: a Spark callable over the driver tables and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[["Tables"], DataFrame]


@dataclass(frozen=True)
class Tables:
    """The driver tables of one scale, read on access: ``t.orders``."""

    spark: SparkSession
    path: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query. ``sql`` is left out where SQL cannot state the result."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return add


def shaped(table: str, columns: Sequence[str], where: str = "") -> str:
    """The SQL twin of ``selectExpr(*columns)``."""
    return f"SELECT {', '.join(columns)} FROM {table} {where}"


def r6(c: Column | str) -> Column:
    """Doubles are compared to six digits."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def text(c: Column | str) -> Column:
    """Dates and three-valued flags are compared as text."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")
