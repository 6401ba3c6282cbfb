"""Filling nulls from group statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.clean import clip
from lodgeframe.operators.quantiles import group_medians, group_mode, quantile_row
from lodgeframe.operators.sizing import attach_by_key


@dataclass(frozen=True)
class Noise:
    """Normal noise on imputed values.

    ``share`` scales the group's sample deviation; ``fallback`` is the deviation used where that
    is unknown or zero; ``fixed`` overrides both. Draws depend only on ``seed``, the column and
    the row key, so they survive repartitioning and task retries.
    """

    key: str
    share: float = 0.1
    fallback: float = 0.05
    zero_is_unknown: bool = True
    fixed: float | None = None
    seed: int = 42
    bounds: tuple[float | None, float | None] = (None, None)


def normal_draw(key: Column, salt: str) -> Column:
    """Standard normal number from two 32-bit parts of a digest (Box-Muller)."""
    digest = F.md5(F.concat(F.lit(f"{salt}|"), key.cast("string")))

    def uniform(start: int) -> Column:
        part = F.conv(F.substring(digest, start, 8), 16, 10).cast("double")
        return (part + F.lit(0.5)) / F.lit(2.0**32)

    return F.sqrt(F.lit(-2.0) * F.ln(uniform(1))) * F.cos(F.lit(2.0 * math.pi) * uniform(9))


def _keys(group: str | Sequence[str]) -> list[str]:
    return [group] if isinstance(group, str) else list(group)


def _filled(target: str, centre: Column, spread: Column | None, noise: Noise | None) -> Column:
    proposal = centre
    if noise is not None:
        scale = F.lit(noise.fixed) if noise.fixed is not None else spread
        proposal = centre + scale * normal_draw(F.col(noise.key), f"{noise.seed}|{target}")
        proposal = clip(proposal, *noise.bounds)
    return F.coalesce(F.col(target), proposal)


def _scale(deviation: Column, noise: Noise) -> Column:
    unknown = deviation.isNull() | F.isnan(deviation)
    if noise.zero_is_unknown:
        unknown = unknown | (deviation == 0)
        return F.when(unknown, F.lit(noise.fallback)).otherwise(deviation * F.lit(noise.share))
    return F.when(unknown, F.lit(noise.fallback)).otherwise(deviation) * F.lit(noise.share)


def _fill(df: DataFrame, stats: DataFrame, names: list[str], keys: list[str], noise: Noise | None) -> DataFrame:
    """Fills nulls from a table of (keys, _m0, _s0, _m1, ...): medians and, where noise wants them, deviations."""
    joined = attach_by_key(df, stats, keys)
    filled = {}
    for i, name in enumerate(names):
        spread = _scale(F.col(f"_s{i}"), noise) if noise is not None and noise.fixed is None else None
        filled[name] = _filled(name, F.col(f"_m{i}"), spread, noise)
    return joined.withColumns(filled).select(*df.columns)


def impute_counted(
    df: DataFrame,
    targets: str | Sequence[str],
    group: str | Sequence[str],
    statistics: DataFrame,
    noise: Noise | None = None,
) -> DataFrame:
    """``impute_median`` from the table of ``counted_statistics``, which serves many imputations at once."""
    keys, names = _keys(group), [targets] if isinstance(targets, str) else list(targets)
    own = statistics.where(F.col("_column").isin(names)).dropna(subset=keys)
    picks = [
        F.max(F.when(F.col("_column") == name, F.col(c))).alias(f"{short}{i}")
        for i, name in enumerate(names)
        for short, c in (("_m", "_median"), ("_s", "_spread"))
    ]
    return _fill(df, own.groupBy(*keys).agg(*picks), names, keys, noise)


def impute_median(
    df: DataFrame,
    targets: str | Sequence[str],
    group: str | Sequence[str],
    noise: Noise | None = None,
    global_fallback: bool = False,
    source: DataFrame | None = None,
) -> DataFrame:
    """Fill nulls with the group's exact median, optionally with noise.

    Rows with a null group key keep what they have. All targets of one call share one join.
    ``global_fallback`` then fills what is left with the median of the filled column.

    In a chain of imputations pass the table before the chain as ``source``: the statistics are
    then read from it instead of running the earlier joins once more.
    """
    keys, names = _keys(group), [targets] if isinstance(targets, str) else list(targets)
    base = df if source is None else source
    spreads = {}
    if noise is not None and noise.fixed is None:
        spreads = {f"_s{i}": F.stddev_samp(F.col(n).cast("double")) for i, n in enumerate(names)}
    medians = {f"_m{i}": name for i, name in enumerate(names)}
    out = _fill(df, group_medians(base, medians, keys, spreads), names, keys, noise)
    if global_fallback:
        rest = {name: quantile_row(out, name, {"m": 0.5})["m"] for name in names}
        out = out.withColumns({n: F.coalesce(n, m) for n, m in rest.items()})
    return out


def impute_mode(
    df: DataFrame,
    target: str,
    group: str | Sequence[str],
    source: DataFrame | None = None,
) -> DataFrame:
    """Fill nulls with the group's most frequent value (lowest on a tie); ``source`` as above."""
    keys = _keys(group)
    modes = group_mode(df if source is None else source, target, keys, "_mode")
    joined = attach_by_key(df, modes, keys)
    return joined.withColumn(target, F.coalesce(target, "_mode")).select(*df.columns)


def group_transform(df: DataFrame, group: str | Sequence[str], **aggregates: Column) -> DataFrame:
    """Group aggregates as extra columns on every row (aggregate, then join back).

    Unlike a window this never puts one group's rows into one task.
    """
    keys = _keys(group)
    table = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return attach_by_key(df, table, keys)
