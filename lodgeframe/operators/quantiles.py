"""Exact quantiles with linear interpolation: one lazy plan for any number of groups, rows and values.

The two ranks around each quantile are found by ``selection``: histograms whose bins are refined until the values are left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators.selection import ALL, COUNT, holds, select_counted, select_ranks
from lodgeframe.operators.sizing import attach_by_key

_NAME = "_column"


def number(c: str | Column) -> Column:
    """The value as a double, with NaN as null."""
    return F.nanvl((F.col(c) if isinstance(c, str) else c).cast("double"), F.lit(None).cast("double"))


def _picked(values: DataFrame, quantiles: Mapping[str, float], by: list[str], select=select_ranks) -> DataFrame:
    """The quantiles of ``_v`` per group. Only the few rows that hold a wanted rank are grouped again."""
    places = [f"(({ALL} - 1) * {float(q)!r}D)" for q in quantiles.values()]
    around = [(f"floor({place})", f"floor({place}) + 1") for place in places]
    found = select(values, by, [rank for pair in around for rank in pair])
    picks = []
    for i, (place, pair) in enumerate(zip(places, around)):
        picks += [F.expr(f"max(CASE WHEN {holds(rank)} THEN _v END)").alias(f"_{side}{i}") for side, rank in zip("ab", pair)]
        picks.append(F.expr(f"max({place} - floor({place}))").alias(f"_p{i}"))
    named = [F.expr(f"_a{i} + coalesce(_b{i} - _a{i}, 0.0D) * _p{i}").alias(name) for i, name in enumerate(quantiles)]
    return found.groupBy(*by).agg(*picks).select(*by, *named)


def _grouped(df: DataFrame, by: list[str]) -> DataFrame:
    """The rows with all group keys. Keys that are never null are not asked: a filter would compute them once more."""
    asked = [c for c in by if df.schema[c].nullable]
    return df.dropna(subset=asked) if asked else df


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    extras: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per group: the named quantiles of ``value`` plus ``extras`` aggregates.

    Null and NaN values are left out of the quantiles; rows with a null group key are left out.
    Groups without any value keep their row, with null quantiles.
    """
    by, extras = list(by), dict(extras or {})
    base = _grouped(df, by)
    own = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), *[agg.alias(name) for name, agg in extras.items()]
    )
    found = _picked(base.select(*by, number(value).alias("_v")).where("_v is not null"), quantiles, by)
    if by:
        return attach_by_key(own, found, by).select(*by, *quantiles, *extras)
    picked = found.select(F.struct(*quantiles).alias("q")).scalar()
    return own.select(*[picked[name].alias(name) for name in quantiles], *extras)


def group_medians(
    df: DataFrame,
    medians: Mapping[str, str],
    by: Sequence[str],
    extras: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Medians of several columns per group: ``medians`` maps output names to columns.

    The columns are stacked, so all of them take one pass.
    """
    by, extras = list(by), dict(extras or {})
    base = _grouped(df, by)
    own = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), *[agg.alias(name) for name, agg in extras.items()]
    )
    stacked = base.select(
        *by,
        F.inline(
            F.array(*[F.struct(F.lit(name).alias(_NAME), number(c).alias("_v")) for name, c in medians.items()])
        ),
    ).where("_v is not null")
    found = _picked(stacked, {"_median": 0.5}, [*by, _NAME])
    wide = found.groupBy(*by).agg(
        *[F.max(F.when(F.col(_NAME) == name, F.col("_median"))).alias(name) for name in medians]
    )
    return attach_by_key(own, wide, by).select(*by, *medians, *extras)


def count_values(df: DataFrame, groupings: Mapping[str, Sequence[str]]) -> DataFrame:
    """(_column, keys, _v, _m): how many rows of a group have each value, for many columns grouped in their own ways.

    ``groupings`` maps a column to its group keys; keys that are not its own are null. One aggregate over one scan
    serves all groupings, combined before its shuffle: what is left are values, not rows. Null and NaN are counted as null.
    """
    keys = list(dict.fromkeys(k for by in groupings.values() for k in by))
    cells = [
        F.struct(
            F.lit(name).alias(_NAME),
            *(F.col(k) if k in by else F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys),
            number(name).alias("_v"),
        )
        for name, by in groupings.items()
    ]
    return df.select(F.inline(F.array(*cells))).groupBy(_NAME, *keys, "_v").agg(F.count(F.lit(1)).alias(COUNT))


def counted_statistics(cells: DataFrame) -> DataFrame:
    """(_column, keys, _median, _spread): exact median and sample deviation of every group of ``count_values``.

    Null values take no part; groups without any other are left out. The deviation of a single value is null.
    """
    by = [c for c in cells.columns if c not in ("_v", COUNT)]
    # Fields of a struct compare with null equal to null, so one key serves groups with keys of their own.
    known = cells.where("_v is not null").select(F.struct(*by).alias("_g"), "_v", COUNT)
    medians = _picked(known, {"_median": 0.5}, ["_g"], select_counted)
    means = known.groupBy("_g").agg((F.sum(F.col("_v") * F.col(COUNT)) / F.sum(COUNT)).alias("_mean"))
    off = F.col("_v") - F.col("_mean")
    rows = F.sum(COUNT)
    spread = F.when(rows > 1, F.sqrt(F.sum(off * off * F.col(COUNT)) / (rows - 1)))
    spreads = attach_by_key(known, means, ["_g"], "inner").groupBy("_g").agg(spread.alias("_spread"))
    return attach_by_key(medians, spreads, ["_g"], "inner").select("_g.*", "_median", "_spread")


def quantile_row(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    extras: Mapping[str, Column] | None = None,
) -> Column:
    """The global quantiles (and extras) as one struct column, read by a scalar subquery."""
    table = exact_quantiles(df, value, quantiles, (), extras)
    return table.select(F.struct(*table.columns).alias("one_row")).scalar()


def group_mode(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "mode") -> DataFrame:
    """Most frequent non-null value per group, the lowest on a tie.

    Counting per (group, value) first keeps a hot group spread over all its values.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    order = F.struct(-F.col("_n"), F.col(value))
    return counted.groupBy(*by).agg(F.min_by(value, order).alias(out))
