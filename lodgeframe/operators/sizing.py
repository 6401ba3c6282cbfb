"""How a small table meets a large one.

Joins carry no hints: Spark broadcasts a side by its size in bytes, planned or measured at run time, and
splits hot keys of shuffle joins. Where an aggregate on the join key follows, which rules that split out,
``spread_join`` deals every key over a fixed number of tasks instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
SALTS = 32


def attach_by_key(detail: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Bring a one-row-per-key table back to the detail rows; null keys match nothing.

    The table's keys get names of their own first. Where it comes from the detail rows itself, both sides would else
    share columns, and Spark rewrites the whole plan of one side to tell them apart, which takes seconds for deep plans.
    """
    own = [f"_key_{i}" for i in range(len(keys))]
    named = table.select(*(F.col(k).alias(o) for k, o in zip(keys, own)), *(c for c in table.columns if c not in keys))
    same = F.lit(True)
    for k, o in zip(keys, own):
        same = same & (F.col(k) == F.col(o))
    return detail.join(named, same, how).drop(*own)


def spread_join(
    detail: DataFrame, table: DataFrame, keys: Sequence[str], over: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """An inner join with a one-row-per-key table that deals each key over ``salts`` tasks by the ``over`` columns.

    The column ``SALT`` stays: aggregate by the keys and it first, then by the keys.
    """
    dealt = detail.withColumn(SALT, F.pmod(F.xxhash64(*over), F.lit(salts)).cast("int"))
    copies = table.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*keys, SALT])


def spread_rows(df: DataFrame, each: int = 4) -> DataFrame:
    """The rows dealt over ``each`` tasks a core, for work that takes long on each row.

    A file's row group, or a file that cannot be split, is read by one task, and all that follows stays with it. Pass only
    the columns that are needed: each row is shuffled once.
    """
    return df.repartition(each * max(2, df.sparkSession.sparkContext.defaultParallelism))


def one_row(df: DataFrame, **aggregates: Column) -> Column:
    """Global aggregates as one struct column: a scalar subquery, so no join is planned."""
    fields = F.struct(*[agg.alias(name) for name, agg in aggregates.items()])
    return df.agg(fields.alias("one_row")).scalar()
