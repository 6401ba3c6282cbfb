"""Group aggregates, counts, pivots, correlations and tests."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.text import REVIEW_STOPWORDS, content_word, words
from lodgeframe.operators.quantiles import exact_quantiles, number
from lodgeframe.operators.tables import null_shares

# Fixed value: two-sided 95 % point of the normal distribution.
Z95 = 1.96


def share_of(condition: Column) -> Column:
    """Share of the rows where a condition is known that meet it."""
    return F.avg(condition.cast("double"))


def rate_by(df: DataFrame, keys: Sequence[str], condition: Column, out: str = "rate") -> DataFrame:
    return df.groupBy(*keys).agg(share_of(condition).alias(out))


def mean_ci(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Mean, standard error and half width of the 95 % interval per group."""
    number = value.cast("double")
    sem = F.try_divide(F.stddev_samp(number), F.sqrt(F.count(number)))
    return df.groupBy(key).agg(
        F.avg(number).alias("mean"), sem.alias("sem"), (sem * F.lit(Z95)).alias("ci95")
    )


def event_stats(
    df: DataFrame, key: str, means: Mapping[str, Column], counted: Column, sort_by: str
) -> DataFrame:
    """Named means and a count per group, highest ``sort_by`` first."""
    aggregates = [F.avg(c.cast("double")).alias(n) for n, c in means.items()]
    out = df.groupBy(key).agg(*aggregates, F.count(counted).alias("n"))
    return out.orderBy(F.col(sort_by).desc(), key)


def peak_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """The key with the largest value (first key on a tie) and that value."""
    best = F.max(F.col(value))
    top = df.groupBy(value).agg(F.min(key).alias(key))
    return top.agg(F.max_by(key, value).alias(key), best.alias(value))


def value_counts(
    df: DataFrame, column: str, top: int | None = None, nulls: bool = False, share: bool = False
) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    rows = df if nulls else df.where(F.col(column).isNotNull())
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    if share:
        total = rows.agg(F.count(F.lit(1)).alias("t")).scalar()
        counted = counted.withColumn("share", F.try_divide(F.col("n").cast("double"), total))
    out = counted.orderBy(F.col("n").desc(), F.col(column).asc_nulls_last())
    return out if top is None else out.limit(top)


def nunique_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def group_median_topn(df: DataFrame, key: str, value: str, top: int = 15) -> DataFrame:
    """Median, mean, min and max per group, highest medians first."""
    extras = {"mean": F.avg(value), "min": F.min(value), "max": F.max(value)}
    table = exact_quantiles(df, value, {"median": 0.5}, [key], extras)
    return table.orderBy(F.col("median").desc_nulls_last(), key).limit(top)


def mean_of_means(
    df: DataFrame, inner: Sequence[str], outer: str, value: Column, out: str = "mean"
) -> DataFrame:
    """Average of the inner groups' averages per outer key."""
    means = df.groupBy(*inner).agg(F.avg(value.cast("double")).alias("_m"))
    return means.groupBy(outer).agg(F.avg("_m").alias(out))


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence, value: Column) -> DataFrame:
    """Mean per (row, column), one column per listed value."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(value.cast("double")))


def pivot_count(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Count per (row, column) with zeros, largest row totals first."""
    names = [str(v) for v in values]
    table = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).fillna(0, names)
    total = F.lit(0)
    for name in names:
        total = total + F.col(f"`{name}`")
    return table.withColumn("total", total).orderBy(F.col("total").desc(), row)


def segment_diff(
    df: DataFrame, key: str, segment: Column, value: Column, inside: str, outside: str
) -> DataFrame:
    """Mean inside and outside a segment per key, and their difference."""
    number = value.cast("double")
    table = df.groupBy(key).agg(
        F.avg(F.when(segment, number)).alias(inside), F.avg(F.when(~segment, number)).alias(outside)
    )
    return table.withColumn("diff", F.col(inside) - F.col(outside))


def counts_by_year(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy("year")


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int | None = 3) -> DataFrame:
    """Pearson correlations over pairwise complete rows as (row, column, value), in one pass.

    Each pair is computed once. The regression sums skip incomplete pairs by themselves, and a
    constant column gives null instead of a division error.
    """
    moments, cells = [], []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            low, high = min(i, j), max(i, j)
            if i <= j:
                y, x = (number(columns[k]) for k in (low, high))
                moments += [
                    F.regr_sxy(y, x).alias(f"xy_{low}_{high}"),
                    F.regr_sxx(y, x).alias(f"xx_{low}_{high}"),
                    F.regr_syy(y, x).alias(f"yy_{low}_{high}"),
                ]
            xy, xx, yy = (F.col(f"{m}_{low}_{high}") for m in ("xy", "xx", "yy"))
            r = F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy))
            value = r if digits is None else F.bround(r, digits)
            cells.append(
                F.struct(F.lit(a).alias("row"), F.lit(b).alias("column"), value.alias("value"))
            )
    return df.agg(*moments).select(F.inline(F.array(*cells)))


def two_sample_t(df: DataFrame, group: Column, value: Column) -> DataFrame:
    """Pooled two-sample t-test of the rows where ``group`` is true against the rest; NaN is no value."""
    x = number(value)
    sides = {"1": F.when(group, x), "0": F.when(~group, x)}
    row = df.agg(
        *[f(v).alias(f"{n}{s}") for s, v in sides.items()
          for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))]
    )
    free = F.col("n1") + F.col("n0") - 2
    pooled = F.try_divide(
        (F.col("n1") - 1) * F.col("var1") + (F.col("n0") - 1) * F.col("var0"), free
    )
    error = F.sqrt(pooled * (F.lit(1.0) / F.col("n1") + F.lit(1.0) / F.col("n0")))
    row = row.withColumn("df", free).withColumn(
        "t", F.try_divide(F.col("mean1") - F.col("mean0"), error)
    )
    return row.withColumn("p", two_sided_p(F.col("t"), F.col("df").cast("double")))


def _ln_gamma(x: Column) -> Column:
    """Stirling series, after shifting the argument up by eight."""
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.ln(x + i)
    z = x + 8
    series = F.lit(1 / 12) / z - F.lit(1 / 360) / F.pow(z, 3) + F.lit(1 / 1260) / F.pow(z, 5)
    return (z - 0.5) * F.ln(z) - z + F.lit(0.9189385332046727) + series - shift


_LEVELS = 300  # of the continued fractions; they converge in far fewer where they are used


def _fraction(terms: int, step) -> Column:
    """``step(1, step(2, ...))`` from the innermost level outwards."""
    levels = F.sequence(F.lit(terms), F.lit(1), F.lit(-1))
    return F.aggregate(levels, F.lit(1.0), lambda f, k: step(k.cast("double"), f))


def normal_tails(z: Column) -> Column:
    """The chance of a standard normal value at least ``z`` away from 0: an incomplete gamma function."""
    y = z * z / 2
    scale = F.exp(-y) * F.sqrt(y / F.lit(math.pi))
    # near 0 a series of the inside, else the continued fraction of the outside
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(F.lit(2.0).alias("term"), F.lit(2.0).alias("sum")),
        lambda acc, n: F.struct(
            (acc["term"] * y / (n + 0.5)).alias("term"), (acc["sum"] + acc["term"] * y / (n + 0.5)).alias("sum")
        ),
    )["sum"]
    outside = scale / (y + 0.5 - _fraction_tail(y))
    return F.when(y < 3, 1 - scale * terms).otherwise(outside)


def _fraction_tail(y: Column) -> Column:
    levels = F.sequence(F.lit(_LEVELS), F.lit(1), F.lit(-1))
    return F.aggregate(levels, F.lit(0.0), lambda f, n: n * (n - 0.5) / (y + 2 * n + 0.5 - f))


def _beta_share(x: Column, ln_x: Column, ln_rest: Column, a: Column, b: Column) -> Column:
    """The regularised incomplete beta function where its continued fraction converges fast."""

    def step(k: Column, f: Column) -> Column:
        m = F.floor(k / 2)
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        return 1 + F.when(k % 2 == 1, odd).otherwise(even) / f

    ln_scale = _ln_gamma(a + b) - _ln_gamma(a) - _ln_gamma(b) + a * ln_x + b * ln_rest
    return F.exp(ln_scale) / (a * _fraction(_LEVELS, step))


def two_sided_p(t: Column, free: Column) -> Column:
    """Two-sided p-value of Student's t for any t and degrees of freedom.

    Up to 1 000 degrees the incomplete beta function by its continued fraction; beyond, t becomes a normal
    value by an expansion whose error there is far below 1e-9.
    """
    square = t * t
    a, half = free / 2, F.lit(0.5)
    x, rest = free / (free + square), square / (free + square)
    ln_x, ln_rest = -F.log1p(square / free), F.ln(rest)
    direct = _beta_share(x, ln_x, ln_rest, a, half)
    other = 1 - _beta_share(rest, ln_rest, ln_x, half, a)
    exact = F.when(square == 0, 1.0).when(x < (a + 1) / (a + 2.5), direct).otherwise(other)
    n = free - 0.5
    y = n * F.log1p(square / free)
    b = 48 * n * n
    correction = (((-0.4 * y - 3.3) * y - 24) * y - 85.5) / (0.8 * y * y + 100 + b)
    z = ((correction + y + 3) / b + 1) * F.sqrt(y)
    return F.when(free <= 1000, exact).otherwise(normal_tails(z))


def null_profile(
    df: DataFrame, columns: Sequence[str] | None = None, top: int | None = None, over: float | None = None
) -> DataFrame:
    """Percent of nulls per column, highest first, from one pass."""
    rows = df.agg(null_shares(df, columns).alias("shares")).select(F.inline("shares"))
    out = rows.select("column_name", F.bround(F.col("share") * 100, 2).alias("pct_null"))
    if over is not None:
        out = out.where(F.col("pct_null") > over)
    out = out.orderBy(F.col("pct_null").desc(), "column_name")
    return out if top is None else out.limit(top)


def word_freq(
    df: DataFrame, text: str, top: int | None = 20, stopwords: Sequence[str] = REVIEW_STOPWORDS
) -> DataFrame:
    """Most frequent words of the whole texts; counted on the map side before the shuffle."""
    found = df.select(F.explode(words(F.col(text))).alias("word"))
    found = found.where(content_word(F.col("word"), stopwords))
    out = found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    out = out.orderBy(F.col("n").desc(), "word")
    return out if top is None else out.limit(top)


def first_per_group(
    df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First value of each column per group, in ``order``."""
    by = F.struct(*order)
    return df.groupBy(key).agg(*[F.min_by(c, by).alias(f"first_{c}") for c in columns])


def coverage_anomalies(
    df: DataFrame, date: str, entity: str, below: float = 0.5
) -> DataFrame:
    """Days with fewer distinct entities than ``below`` times the median day."""
    days = df.groupBy(date).agg(F.count_distinct(entity).alias("n"))
    # One row per day: the median of this table needs no more than the calendar.
    usual = days.agg(F.median("n").alias("m")).scalar()
    return days.withColumn("expected", usual).where(F.col("n") < F.lit(below) * F.col("expected"))


def entity_rate(df: DataFrame, entity: str, condition: Column) -> DataFrame:
    """Rate and number of observations per entity."""
    number = condition.cast("double")
    return df.groupBy(entity).agg(F.avg(number).alias("rate"), F.count(number).alias("n"))


def consistency(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Per check, whether it holds on all rows and on what share; unknown counts as not."""
    cells = []
    for name, check in checks.items():
        held = F.coalesce(check, F.lit(False))
        cells.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.every(held).alias("holds"),
                F.avg(held.cast("double")).alias("share"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def typed_counts(
    df: DataFrame, key: str, kind: str, kinds: Mapping[str, str], declared: str
) -> DataFrame:
    """Counts per key and kind against a declared total, with the part no kind explains."""
    table = df.groupBy(key).agg(
        F.max(declared).alias("declared"),
        F.count(F.lit(1)).alias("computed"),
        *[F.count_if(F.col(kind) == value).alias(name) for name, value in kinds.items()],
    )
    rest = F.col("declared")
    for name in kinds:
        rest = rest - F.col(name)
    return table.withColumn("other", F.when(rest < 0, F.lit(0)).otherwise(rest))


