"""Distributions, quantiles and outliers, on the line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators import aggregates as A
from lodgeframe.operators import distributions as D
from lodgeframe.operators.quantiles import exact_quantiles, quantile_row
from lodgeframe.operators.tables import trim_quantile
from lodgeframe.queries.registry import Tables, query, r6

# The line items with NaN for the price of every eleventh order and the quantity of every thirteenth;
# the SQL side has null there, which must come to the same.
HOLED = """(SELECT * REPLACE (CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_quantity END AS l_quantity) FROM lineitem)"""


def holed(t: Tables) -> DataFrame:
    def hole(column: str, every: int):
        return F.when(F.col("l_orderkey") % every == 0, F.lit(float("nan"))).otherwise(F.col(column))

    return t.lineitem.withColumns({"l_extendedprice": hole("l_extendedprice", 11), "l_quantity": hole("l_quantity", 13)})


def edges_sql(rows: str, n: int, lo: str, hi: str, left: str = "a", right: str = "b") -> str:
    """Counts per listed interval [a, b), the last one closed, by comparing with the edges."""
    return f"""{rows}, span AS (SELECT {lo} AS lo, {hi} AS hi FROM x),
    edges AS (SELECT CAST(i AS INT) AS bin, lo + i * ((hi - lo) / {n}) AS a,
      CASE WHEN i = {n - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {n}) END AS b FROM span, range({n}) r(i))
    SELECT bin, {left} AS "left", {right} AS "right", count(x.v) AS n FROM edges LEFT JOIN x
      ON x.v >= a AND (x.v < b OR (bin = {n - 1} AND x.v = b)) GROUP BY bin, a, b"""


@query(
    "histogram",
    edges_sql("WITH x AS (SELECT least(l_extendedprice, 80000) AS v FROM lineitem WHERE l_orderkey % 11 <> 0)", 40, "min(v)", "max(v)",
              "round(a, 6)", "round(b, 6)"),
)
def histogram(t: Tables) -> DataFrame:
    table = D.histogram(holed(t), "l_extendedprice", 40, clip_upper=80000)
    return table.select("bin", r6("left").alias("left"), r6("right").alias("right"), "n")


@query(
    "histogram_p95",
    edges_sql("WITH x AS (SELECT l_quantity AS v FROM lineitem)", 10, "0.0::DOUBLE",
              "CAST(floor(quantile_cont(v, 0.95)) AS DOUBLE)", "round(a, 6)", "round(b, 6)"),
)
def histogram_p95(t: Tables) -> DataFrame:
    top = quantile_row(t.lineitem, "l_quantity", {"p95": 0.95})["p95"].cast("int")
    table = D.histogram(t.lineitem, "l_quantity", 10, lo=0.0, hi=top)
    return table.select("bin", r6("left").alias("left"), r6("right").alias("right"), "n")


@query(
    "cut_equal_median",
    f"""WITH h AS {HOLED}, s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM h),
    e AS (SELECT CAST(i AS INT) AS bin, lo + i * ((hi - lo) / 10) AS a,
      CASE WHEN i = 9 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 10) END AS b FROM s, range(10) r(i))
    SELECT bin, round(a, 6) AS "left", round(b, 6) AS "right", round(coalesce(median(l_extendedprice), 0), 6) AS median,
      count(l_quantity) AS n FROM e LEFT JOIN h ON l_quantity <= b AND (l_quantity > a OR (bin = 0 AND l_quantity = a))
    GROUP BY bin, a, b""",
)
def cut_equal_median(t: Tables) -> DataFrame:
    table = D.cut_equal_median(holed(t), "l_quantity", "l_extendedprice", 10)
    return table.select("bin", *[r6(c).alias(c) for c in ("left", "right", "median")], "n")


# Edges and labels of the minimum-stay groups.
STAY_EDGES = [0, 1, 2, 3, 7, 14, 30, 100, 9999]
STAY_LABELS = ["1", "2", "3", "4-7", "8-14", "15-30", "31-100", ">100"]


@query(
    "cut_edges",
    """WITH g AS (SELECT CASE WHEN v <= 0 THEN NULL WHEN v <= 1 THEN '1' WHEN v <= 2 THEN '2' WHEN v <= 3 THEN '3' WHEN v <= 7 THEN '4-7'
      WHEN v <= 14 THEN '8-14' WHEN v <= 30 THEN '15-30' WHEN v <= 100 THEN '31-100' WHEN v <= 9999 THEN '>100' END AS nights, l_discount
      FROM (SELECT l_quantity - 2 AS v, l_discount FROM lineitem))
    SELECT nights, round(avg(l_discount), 6) AS mean, count(*) AS n FROM g WHERE nights IS NOT NULL GROUP BY nights""",
)
def cut_edges(t: Tables) -> DataFrame:
    label = D.cut_edges(F.col("l_quantity") - 2, STAY_EDGES, STAY_LABELS)
    df = t.lineitem.withColumn("nights", label).where("nights is not null")
    return df.groupBy("nights").agg(r6(F.avg("l_discount")).alias("mean"), F.count(F.lit(1)).alias("n"))


@query(
    "qcut_segments",
    """WITH b AS (SELECT quantile_cont(l_quantity, 0.25) AS p1, quantile_cont(l_quantity, 0.5) AS p2, quantile_cont(l_quantity, 0.75) AS p3 FROM lineitem)
    SELECT CASE WHEN l_quantity <= p1 THEN 'low' WHEN l_quantity <= p2 THEN 'mid-low' WHEN l_quantity <= p3 THEN 'mid-high' ELSE 'high' END AS segment,
      count(*) AS n FROM lineitem, b GROUP BY 1""",
)
def qcut_segments(t: Tables) -> DataFrame:
    df = D.qcut(t.lineitem, "l_quantity", ["low", "mid-low", "mid-high", "high"])
    return df.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


WANTED = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p995": 0.995}


@query(
    "quantiles",
    "SELECT "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 6) AS {n}" for n, q in WANTED.items())
    + " FROM lineitem",
)
def quantiles(t: Tables) -> DataFrame:
    table = exact_quantiles(t.lineitem, "l_extendedprice", WANTED)
    return table.select(*[r6(c).alias(c) for c in WANTED])


@query(
    "quantiles_by_bracket",
    "SELECT l_returnflag, "
    + ", ".join(f"round(quantile_cont(l_extendedprice, {q}), 6) AS {n}" for n, q in WANTED.items())
    + " FROM lineitem GROUP BY l_returnflag",
)
def quantiles_by_bracket(t: Tables) -> DataFrame:
    """Quantiles of few large groups, which span many slices."""
    table = exact_quantiles(t.lineitem, "l_extendedprice", WANTED, ["l_returnflag"])
    return table.select("l_returnflag", *[r6(c).alias(c) for c in WANTED])


DESCRIBED = ("mean", "std", "min", "p25", "p50", "p75", "max")
DESCRIBE_SQL = f"""count(v) AS "count", round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS "min",
  round(quantile_cont(v, 0.25), 4) AS p25, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75,
  round(max(v), 4) AS "max" FROM (SELECT l_extendedprice AS v, * FROM {HOLED})"""


@query("describe", "SELECT " + DESCRIBE_SQL)
def describe(t: Tables) -> DataFrame:
    table = D.describe(holed(t), "l_extendedprice")
    return table.select("count", *[F.round(c, 4).alias(c) for c in DESCRIBED])


@query("describe_by", "SELECT l_returnflag, l_linestatus, " + DESCRIBE_SQL + " GROUP BY l_returnflag, l_linestatus")
def describe_by(t: Tables) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    table = D.describe(holed(t), "l_extendedprice", keys)
    return table.select(*keys, "count", *[F.round(c, 4).alias(c) for c in DESCRIBED])


@query(
    "trim_quantile",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_extendedprice < (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)""",
)
def trim(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return trim_quantile(df, "l_extendedprice", 0.99)


@query(
    "zscore_outliers",
    f"""WITH h AS {HOLED}, s AS (SELECT avg(v) AS m, stddev_pop(v) AS sd FROM (SELECT l_extendedprice * l_quantity AS v FROM h))
    SELECT l_orderkey, l_linenumber, round((l_extendedprice * l_quantity - m) / sd, 6) AS z FROM h, s
    WHERE abs((l_extendedprice * l_quantity - m) / sd) > 3""",
)
def zscore_outliers(t: Tables) -> DataFrame:
    df = holed(t).withColumn("v", F.col("l_extendedprice") * F.col("l_quantity"))
    return D.zscore_outliers(df, "v").select("l_orderkey", "l_linenumber", r6("z").alias("z"))


@query(
    "outlier_flags",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.995) AS a, quantile_cont(l_quantity, 0.9) AS b FROM lineitem),
    f AS (SELECT l_extendedprice > a OR l_extendedprice <= 1000 AS price, l_quantity > b AS quantity,
      l_linenumber > l_quantity AS lines FROM lineitem, q)
    SELECT CAST(price AS INT) + CAST(quantity AS INT) + CAST(lines AS INT) AS total_flags, count(*) AS n,
      count(*) FILTER (price) AS n_price, count(*) FILTER (quantity) AS n_quantity, count(*) FILTER (lines) AS n_lines
    FROM f GROUP BY 1""",
)
def outlier_flags(t: Tables) -> DataFrame:
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    top = quantile_row(t.lineitem, "l_extendedprice", {"p": 0.995})["p"]
    many = quantile_row(t.lineitem, "l_quantity", {"p": 0.9})["p"]
    df = D.outlier_flags(
        t.lineitem,
        {
            "price": (price > top) | (price <= 1000),
            "quantity": quantity > many,
            "lines": F.col("l_linenumber") > quantity,
        },
    )
    return df.groupBy("total_flags").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(c).alias(f"n_{c}") for c in ("price", "quantity", "lines")],
    )


@query(
    "box_stats",
    """WITH q AS (SELECT l_returnflag, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
      FROM (SELECT *, l_extendedprice * l_quantity AS v FROM lineitem) GROUP BY l_returnflag),
    j AS (SELECT l.l_returnflag, l_extendedprice * l_quantity AS v, q1, q2, q3,
      v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM lineitem l JOIN q USING (l_returnflag))
    SELECT l_returnflag, round(max(q1), 4) AS q1, round(max(q2), 4) AS q2, round(max(q3), 4) AS q3,
      round(min(v) FILTER (ok), 4) AS whisker_low, round(max(v) FILTER (ok), 4) AS whisker_high,
      count(*) FILTER (NOT ok) AS n_outliers, count(v) AS n FROM j GROUP BY l_returnflag""",
)
def box_stats(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("v", F.col("l_extendedprice") * F.col("l_quantity"))
    table = D.box_stats(df, "v", "l_returnflag")
    rounded = [F.round(c, 4).alias(c) for c in ("q1", "q2", "q3", "whisker_low", "whisker_high")]
    return table.select("l_returnflag", *rounded, "n_outliers", "n")


CORRELATED = ("quantity", "price", "discount", "tax")
CORRELATION_INPUT = [
    "l_quantity AS quantity",
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price",
    "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_discount END AS discount",
    "l_tax AS tax",
]


@query(
    "corr_matrix",
    f"WITH c AS (SELECT {', '.join(CORRELATION_INPUT)} FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"row\", '{b}' AS \"column\", round(corr({a}, {b}), 6) AS value FROM c"
        for a in CORRELATED
        for b in CORRELATED
    ),
)
def corr_matrix(t: Tables) -> DataFrame:
    with_nan = [c.replace("THEN NULL", "THEN double('NaN')") for c in CORRELATION_INPUT]
    table = A.corr_matrix(t.lineitem.selectExpr(*with_nan), CORRELATED, digits=None)
    return table.select("row", "column", r6("value").alias("value"))


@query(
    "ecdf",
    """WITH n AS (SELECT l_extendedprice, count(*) AS c FROM lineitem GROUP BY 1)
    SELECT l_extendedprice, CAST(sum(c) OVER (ORDER BY l_extendedprice) AS BIGINT) AS n_le,
      round(sum(c) OVER (ORDER BY l_extendedprice) / (SELECT count(*) FROM lineitem)::DOUBLE, 6) AS ecdf FROM n""",
)
def ecdf(t: Tables) -> DataFrame:
    return D.ecdf(t.lineitem, "l_extendedprice").select("l_extendedprice", "n_le", r6("ecdf").alias("ecdf"))


@query(
    "ecdf_rates",
    """WITH n AS (SELECT l_quantity, count(*) AS c FROM lineitem GROUP BY 1)
    SELECT l_quantity, CAST(sum(c) OVER (ORDER BY l_quantity) AS BIGINT) AS n_le,
      round(sum(c) OVER (ORDER BY l_quantity) / (SELECT count(*) FROM lineitem)::DOUBLE, 6) AS ecdf FROM n""",
)
def ecdf_rates(t: Tables) -> DataFrame:
    return D.ecdf(t.lineitem, "l_quantity").select("l_quantity", "n_le", r6("ecdf").alias("ecdf"))


@query(
    "predicate_share",
    """SELECT round(avg(CAST(l_quantity > 30 AS INT)), 6) AS share, count(*) FILTER (l_discount >= 0.05) AS n_discounted,
    count(*) FILTER (l_returnflag = 'R' AND l_tax = 0) AS n_untaxed_returns FROM lineitem""",
)
def predicate_share(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        r6(A.share_of(F.col("l_quantity") > 30)).alias("share"),
        F.count_if(F.col("l_discount") >= 0.05).alias("n_discounted"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)).alias("n_untaxed_returns"),
    )


@query(
    "residual_counts",
    """SELECT l_suppkey, max(l_suppkey % 1000) AS declared, count(*) AS computed,
      count(*) FILTER (l_returnflag = 'A') AS n_a, count(*) FILTER (l_returnflag = 'R') AS n_r,
      CASE WHEN max(l_suppkey % 1000) < count(*) FILTER (l_returnflag IN ('A', 'R')) THEN 0
      ELSE max(l_suppkey % 1000) - count(*) FILTER (l_returnflag IN ('A', 'R')) END AS other FROM lineitem GROUP BY l_suppkey""",
)
def residual_counts(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("declared", F.col("l_suppkey") % 1000)
    return A.typed_counts(df, "l_suppkey", "l_returnflag", {"n_a": "A", "n_r": "R"}, "declared")


@query(
    "sort_nulls_last",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price
    FROM lineitem ORDER BY price DESC NULLS LAST, l_orderkey, l_linenumber""",
)
def sort_nulls_last(t: Tables) -> DataFrame:
    price = F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).alias("price")
    df = t.lineitem.select("l_orderkey", "l_linenumber", price)
    return df.orderBy(F.col("price").desc_nulls_last(), "l_orderkey", "l_linenumber")


@query(
    "topk_counts",
    "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 15",
)
def topk_counts(t: Tables) -> DataFrame:
    return A.value_counts(t.lineitem, "l_partkey", top=15)
