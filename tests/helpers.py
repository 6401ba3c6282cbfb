from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession


def values(spark: SparkSession, rows: list, ddl: str, column) -> list:
    """The results of one Column over literal rows, in row order."""
    one = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
    df = spark.createDataFrame(one, f"_i int, {ddl}")
    out: Column = column
    return [r[0] for r in df.select("_i", out.alias("out")).orderBy("_i").select("out").collect()]


def rows(df: DataFrame, *order: str) -> list[tuple]:
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().toString()
