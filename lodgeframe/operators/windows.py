"""Moving averages over daily tables and changes along an entity's history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.functions.dates import month_start
from lodgeframe.operators.ordered import with_previous


def centred_means(daily: DataFrame, date: str, value: str, sizes: dict[str, int]) -> DataFrame:
    """Centred moving averages over rows; null where the window is not full.

    For even sizes the longer half lies before the row. The input must be aggregated to one row
    per day, which bounds this window by the calendar, not by the data.
    """
    out = {}
    for name, size in sizes.items():
        after = (size - 1) // 2
        frame = Window.orderBy(date).rowsBetween(after - size + 1, after)
        full = F.count(value).over(frame) == size
        out[name] = F.when(full, F.avg(value).over(frame))
    return daily.withColumns(out)


def change_flags(
    df: DataFrame, entity: str, order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """``<column>_changed``: differs from the entity's previous row; its first row counts as changed."""
    rows = with_previous(df, entity, order, columns)
    flags = {
        f"{c}_changed": F.coalesce(F.col(c) != F.col(f"prev.{c}"), F.lit(True)) for c in columns
    }
    return rows.withColumns(flags).drop("prev")


def monthly_changes(df: DataFrame, entity: str, date: str, value: str) -> DataFrame:
    """Per month, how many entities show more than one distinct value."""
    seen = df.groupBy(month_start(F.col(date)).alias("month"), entity).agg(
        F.count_distinct(value).alias("_values")
    )
    return seen.groupBy("month").agg(F.count_if(F.col("_values") > 1).alias("n_changed"))
