"""Histograms, cuts, summaries and outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.clean import is_true
from lodgeframe.operators.ordered import with_running_sum
from lodgeframe.operators.quantiles import exact_quantiles, number, quantile_row
from lodgeframe.operators.sizing import SALT, one_row, spread_join

QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def _bins(df: DataFrame, n: int) -> DataFrame:
    return df.sparkSession.range(n).select(F.col("id").cast("int").alias("bin"))


def _ends(
    rows: DataFrame, x: str, lo: Column | None = None, hi: Column | None = None, widen: bool = False
) -> Column:
    """The two ends of the value range as one struct, from a one-row subquery.

    0 and 1 without any value and, with ``widen``, half a unit around a single value, both as in NumPy.
    """
    found = rows.agg(
        (F.min(x) if lo is None else F.max(lo)).cast("double").alias("lo"),
        (F.max(x) if hi is None else F.max(hi)).cast("double").alias("hi"),
    )
    known = F.col("lo").isNotNull() & F.col("hi").isNotNull()
    found = found.select(F.when(known, F.col("lo")).otherwise(0.0).alias("lo"), F.when(known, F.col("hi")).otherwise(1.0).alias("hi"))
    room = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(0.0) if widen else F.lit(0.0)
    return found.select(F.struct((F.col("lo") - room).alias("lo"), (F.col("hi") + room).alias("hi")).alias("ends")).scalar()


def _edge(lo: Column, hi: Column, n: int, i: Column) -> Column:
    """The edge number ``i`` of ``n`` equal bins; the last one is the end itself."""
    return F.when(i >= n, hi).otherwise(lo + i * ((hi - lo) / n))


def histogram(
    df: DataFrame,
    value: str,
    n: int,
    lo: Column | float | None = None,
    hi: Column | float | None = None,
    clip_upper: float | None = None,
) -> DataFrame:
    """Counts in ``n`` equal bins: left-closed, the last one closed; outside values, null and NaN are dropped.

    Bounds default to the smallest and largest value. Empty bins are listed with 0.
    """
    x = number(value)
    if clip_upper is not None:
        x = F.when(x > clip_upper, F.lit(float(clip_upper))).otherwise(x)
    rows = df.select(x.alias("_x")).where("_x is not null")
    lo, hi = (c if c is None or isinstance(c, Column) else F.lit(float(c)) for c in (lo, hi))
    ends = _ends(rows, "_x", lo, hi, widen=True)
    bounded = rows.withColumn("_e", ends)
    lo_, hi_, g = F.col("_e.lo"), F.col("_e.hi"), F.col("_g")
    guess = F.least(F.floor((F.col("_x") - lo_) / (hi_ - lo_) * n).cast("int"), F.lit(n - 1))
    placed = bounded.where(F.col("_x").between(lo_, hi_)).withColumn("_g", guess)
    # The quotient may land next to an edge; the edges themselves decide.
    exact = (
        F.when(F.col("_x") < _edge(lo_, hi_, n, g), g - 1)
        .when((F.col("_x") >= _edge(lo_, hi_, n, g + 1)) & (g < n - 1), g + 1)
        .otherwise(g)
    )
    counts = placed.groupBy(exact.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # Both sides hold at most n rows.
    return _bins(df, n).withColumn("_e", ends).join(F.broadcast(counts), "bin", "left").select(
        "bin",
        _edge(lo_, hi_, n, F.col("bin")).alias("left"),
        _edge(lo_, hi_, n, F.col("bin") + 1).alias("right"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _cut(df: DataFrame, value: str, ends: Column, n: int) -> DataFrame:
    bounded = df.withColumns({"_x": number(value), "_e": ends})
    lo_, hi_, x_, g = F.col("_e.lo"), F.col("_e.hi"), F.col("_x"), F.col("_g")
    guess = F.greatest(F.ceil((x_ - lo_) / (hi_ - lo_) * n).cast("int"), F.lit(1)) - 1
    exact = (
        F.when(lo_ == hi_, F.lit((n - 1) // 2))
        .when((x_ <= _edge(lo_, hi_, n, g)) & (g > 0), g - 1)
        .when((x_ > _edge(lo_, hi_, n, g + 1)) & (g < n - 1), g + 1)
        .otherwise(g)
    )
    placed = bounded.withColumn("_g", F.when(x_.isNotNull() & (lo_ < hi_), guess))
    return placed.withColumn("bin", F.when(x_.isNotNull(), exact)).drop("_x", "_e", "_g")


def _known(df: DataFrame, value: str) -> Column:
    return _ends(df.select(number(value).alias("_x")), "_x")


def cut_equal(df: DataFrame, value: str, n: int) -> DataFrame:
    """Add ``bin`` (0-based) of ``n`` equal right-closed intervals, the lowest value included; null for null and NaN."""
    return _cut(df, value, _known(df, value), n)


def cut_equal_median(df: DataFrame, by_value: str, value: str, n: int = 10) -> DataFrame:
    """Median of ``value`` per equal-width interval of ``by_value``; empty intervals give 0."""
    ends = _known(df, by_value)
    # filtered before the binning, so that the bin is never null and is computed once
    known = df.select(by_value, value).where(number(by_value).isNotNull())
    rows = _cut(known, by_value, ends, n).withColumn("bin", F.coalesce("bin", F.lit(0)))
    medians = exact_quantiles(rows, value, {"median": 0.5}, ["bin"], {"n": F.count(F.lit(1))})
    # Both sides hold at most n rows.
    lo, hi = F.col("_e.lo"), F.col("_e.hi")
    return _bins(df, n).withColumn("_e", ends).join(F.broadcast(medians), "bin", "left").select(
        "bin",
        _edge(lo, hi, n, F.col("bin")).alias("left"),
        _edge(lo, hi, n, F.col("bin") + 1).alias("right"),
        F.coalesce("median", F.lit(0.0)).alias("median"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def cut_edges(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval between listed edges; outside gives null."""
    chain = F.when(c.isNull() | (c <= edges[0]), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels, strict=True):
        chain = chain.when(c <= edge, label)
    return chain


def qcut(df: DataFrame, value: str, labels: Sequence[str], out: str = "segment") -> DataFrame:
    """Quantile segments with equal values sharing a segment (right-closed)."""
    parts = len(labels)
    names = {f"b{i}": i / parts for i in range(1, parts)}
    bounds = quantile_row(df, value, names)
    x = number(value)
    chain = F.when(x.isNull(), F.lit(None).cast("string"))
    for name, label in zip(names, labels):
        chain = chain.when(x <= bounds[name], label)
    return df.withColumn(out, chain.otherwise(F.lit(labels[-1])))


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, exact quartiles and max, overall or per group; NaN is no value."""
    x = number(value)
    extras = {
        "count": F.count(x),
        "mean": F.avg(x),
        "std": F.stddev_samp(x),
        "min": F.min(x),
        "max": F.max(x),
    }
    return exact_quantiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by, extras)


def ecdf(df: DataFrame, value: str) -> DataFrame:
    """Distinct values in order with the share of rows at or below each.

    Equal values are counted first; the running sum then works slice by slice.
    """
    counted = (
        df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    )
    total = df.agg(F.count(value).alias("t")).scalar()
    running = with_running_sum(counted, [value], "_n", "n_le")
    return running.select(value, "n_le", (F.col("n_le") / total.cast("double")).alias("ecdf"))


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, whisker ends (furthest values within 1.5 IQR) and outlier count per group."""
    quartiles = exact_quantiles(df, value, QUARTILES, [by])
    reach = (F.col("q3") - F.col("q1")) * 1.5
    fences = quartiles.withColumn("_low", F.col("q1") - reach).withColumn(
        "_high", F.col("q3") + reach
    )
    # Equal values are counted first; a hot group is dealt over several tasks before it is summed up.
    counted = df.select(by, number(value).alias("_x")).groupBy(by, "_x").agg(F.count(F.lit(1)).alias("_m"))
    rows = spread_join(counted, fences, [by], ["_x"])
    x, m = F.col("_x"), F.col("_m")
    inside = x.between(F.col("_low"), F.col("_high"))
    parts = rows.groupBy(by, SALT).agg(
        *[F.max(q).alias(q) for q in QUARTILES],
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.sum(F.when(~inside, m).otherwise(0)).alias("n_outliers"),
        F.sum(F.when(x.isNotNull(), m).otherwise(0)).alias("n"),
    )
    return parts.groupBy(by).agg(
        *[F.max(q).alias(q) for q in QUARTILES],
        F.min("whisker_low").alias("whisker_low"),
        F.max("whisker_high").alias("whisker_high"),
        F.sum("n_outliers").alias("n_outliers"),
        F.sum("n").alias("n"),
    )


def zscore_outliers(df: DataFrame, value: str, limit: float = 3.0) -> DataFrame:
    """Rows more than ``limit`` population deviations from the mean, with their z; NaN is no value."""
    x = number(value)
    m = one_row(df, mean=F.avg(x), sd=F.stddev_pop(x))
    z = F.try_divide(x - m["mean"], m["sd"])
    return df.withColumn("z", z).where(F.abs("z") > limit)


def outlier_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Named boolean flags (unknown is false) and ``total_flags`` per row."""
    out = df.withColumns({name: is_true(flag) for name, flag in flags.items()})
    total = F.lit(0)
    for name in flags:
        total = total + F.col(name).cast("int")
    return out.withColumn("total_flags", total)
