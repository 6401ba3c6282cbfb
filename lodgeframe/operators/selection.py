"""Exact selection by refining histograms.

Values are counted into bins, and only the bins that hold a wanted rank go on to the next round: first bins of a
fixed number to the octave, which fit any range, then equal parts of what is left in such a bin, then the values
themselves. Every round is a count that is combined before its shuffle, so neither a hot group nor a hot value is a
task of its own; nothing is sorted or sampled as a whole, and nothing runs while the DataFrame is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.operators.sizing import attach_by_key

PER_OCTAVE, PARTS = 1024, 4096
COUNT, SEEN, ALL = "_m", "_seen", "_n"  # rows of a cell, rows up to and with it, rows of the group


def octave_bin(v: str) -> Column:
    """A number that never falls when ``v`` grows: ``PER_OCTAVE`` to each power of two, on both sides of zero.

    Rounding may put a value next to a power of two into the neighbouring bin, but never out of order.
    """
    exponent = f"floor(log2(abs({v})))"
    inside = f"floor((abs({v}) / pow(2.0D, {exponent}) - 1) * {PER_OCTAVE})"
    place = f"CASE WHEN abs({v}) = double('infinity') THEN {1 << 40} ELSE ({exponent} + 1100) * {2 * PER_OCTAVE} + {inside} END"
    return F.expr(f"CAST(CASE WHEN {v} = 0 THEN 0 ELSE signum({v}) * ({place}) END AS BIGINT)")


def part_bin(v: str, lo: str, hi: str) -> Column:
    """The number of the equal part of [lo, hi] that ``v`` is in; one part where the width has no finite length."""
    part = f"least(floor(({v} - {lo}) / ({hi} - {lo}) * {PARTS}), {PARTS - 1})"
    return F.expr(f"CAST(CASE WHEN {hi} > {lo} AND {hi} - {lo} < double('infinity') THEN {part} ELSE 0 END AS INT)")


def holds(rank: str) -> str:
    """Whether a cell holds a 0-based rank, as SQL: one text is parsed faster than many columns are built."""
    return f"({SEEN} - {COUNT} <= {rank} AND {SEEN} > {rank})"


def _holding(cells: DataFrame, part: Sequence[str], order: str, ranks: Sequence[str], before: str) -> DataFrame:
    """The cells that hold a wanted rank, with the rows seen up to them; ``before`` counts those ahead of the part."""
    running = f"sum({COUNT}) OVER (PARTITION BY {', '.join(map(_name, part))} ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    seen = cells.withColumn(SEEN, F.expr(f"{before} + {running}"))
    return seen.where(" OR ".join(map(holds, ranks)))


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _binned(cells: DataFrame, keys: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    bounds = [F.sum(COUNT).alias(COUNT), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    return cells.groupBy(*keys).agg(*bounds, *(F.max(c).alias(c) for c in carried))


def select_ranks(values: DataFrame, by: Sequence[str], ranks: Sequence[str]) -> DataFrame:
    """(by, _v, _m, _seen, _n): the values of ``_v`` that hold a wanted rank of their group, with the rows of each
    value, the rows up to and with it and the rows of the group.

    ``ranks`` are 0-based numbers, SQL over ``_n``; those outside a group are left out. Equal values are counted
    first, and all rounds share that count: its shuffle is reused. ``_v`` is a double without nulls and NaN.
    """
    group = list(by) or ["_all"]
    rows = values if by else values.withColumn("_all", F.lit(0))
    return select_counted(rows.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias(COUNT)), group, ranks).select(*by, "_v", COUNT, SEEN, ALL)


def select_counted(cells: DataFrame, by: Sequence[str], ranks: Sequence[str]) -> DataFrame:
    """The same from values that are counted already: ``cells`` holds ``by``, ``_v`` and ``_m``, a value once a group."""
    group = list(by)
    placed = cells.withColumn("_bin", octave_bin("_v"))
    # a group has a bounded number of bins, whatever it has in rows
    whole = Window.partitionBy(*group)
    bins = _binned(placed, [*group, "_bin"]).withColumn(ALL, F.sum(COUNT).over(whole))
    held = _holding(bins, group, "_bin", ranks, "0")
    held = held.select(*group, "_bin", "_lo", "_hi", (F.col(SEEN) - F.col(COUNT)).alias("_from"), ALL)
    left = attach_by_key(placed, held, [*group, "_bin"], "inner").withColumn("_part", part_bin("_v", "_lo", "_hi"))
    parts = _binned(left.drop("_lo", "_hi"), [*group, "_bin", "_part"], ["_from", ALL])
    narrow = _holding(parts, [*group, "_bin"], "_part", ranks, "_from")
    narrow = narrow.select(*group, "_bin", "_part", (F.col(SEEN) - F.col(COUNT)).alias("_ahead"))
    few = attach_by_key(left, narrow, [*group, "_bin", "_part"], "inner")
    return _holding(few, [*group, "_bin", "_part"], "_v", ranks, "_ahead").select(*group, "_v", COUNT, SEEN, ALL)
