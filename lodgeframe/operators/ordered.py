"""Order-dependent work on data of any size.

The rows are range-partitioned on the whole sort key and written once, which fixes slices of even
size however skewed the keys are: a hot key simply spans several slices. Windows then run inside
slices, and what crosses a slice boundary is carried over by a table with one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.session import checkpointed

SLICE = "_slice"


def sliced(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with the number of their slice; slices follow one another in ``order``, nulls first."""
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    return checkpointed(ranged.withColumn(SLICE, F.spark_partition_id()))


def with_previous(
    df: DataFrame, entity: str, order: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Add ``prev``: a struct of ``columns`` from the entity's previous row, null on its first.

    Nulls in ``order`` come first. Rows without an entity have no previous row.
    """
    rows = sliced(df, [entity, *order])
    inside = Window.partitionBy(SLICE, entity).orderBy(*order)
    rows = rows.withColumn("_before", F.lag(F.struct(*columns)).over(inside))
    tails = rows.groupBy(SLICE).agg(
        F.max(F.struct(entity, *order, F.struct(*columns).alias("_last"))).alias("_tail")
    )
    # One row per slice, so this window and the broadcast are bounded by the partition count.
    carried = tails.select(
        F.col(SLICE), F.lag("_tail").over(Window.orderBy(SLICE)).alias("_carry")
    )
    return (
        rows.join(F.broadcast(carried), SLICE, "left")
        .withColumn(
            "prev",
            F.when(
                F.col(entity).isNotNull(),
                F.coalesce(
                    "_before",
                    F.when(F.col(f"_carry.{entity}") == F.col(entity), F.col("_carry._last")),
                ),
            ),
        )
        .drop(SLICE, "_before", "_carry")
    )


def with_running_sum(df: DataFrame, order: Sequence[str], weight: str, out: str) -> DataFrame:
    """Add the running sum of ``weight`` over the whole table in ``order`` (unique keys)."""
    rows = sliced(df, order)
    inside = (
        Window.partitionBy(SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = rows.groupBy(SLICE).agg(F.sum(weight).alias("_total"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, see above.
    offsets = totals.select(
        F.col(SLICE), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        rows.withColumn("_inside", F.sum(weight).over(inside))
        .join(F.broadcast(offsets), SLICE)
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop(SLICE, "_inside", "_offset")
    )
