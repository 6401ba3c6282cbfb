"""Calendar-like questions, on the order dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import clean as C
from lodgeframe.functions import dates as D
from lodgeframe.operators import aggregates as A
from lodgeframe.operators.lookups import event_windows, interval_join, range_join, totals_after
from lodgeframe.operators.sizing import attach_by_key, one_row
from lodgeframe.operators.windows import centred_means
from lodgeframe.queries.registry import Tables, query, r6, shaped, text

DAYS = [
    "o_orderkey",
    "o_custkey",
    "o_totalprice",
    "CAST(o_orderdate AS DATE) AS day",
    "o_orderstatus = 'F' AS booked",
    "CAST(o_orderkey % 7 + 1 AS INT) AS min_nights",
    "CAST(o_orderkey % 30 + 1 AS INT) AS max_nights",
]
WITH = f"WITH d AS (SELECT {', '.join(DAYS)} FROM orders)"
DAILY = WITH + ", r AS (SELECT day, avg(CAST(booked AS DOUBLE)) AS rate FROM d GROUP BY day)"

# Easter Sundays from published tables: the check does not repeat the algorithm it checks.
EASTER = """easter(y, sunday) AS (VALUES (1992, DATE '1992-04-19'), (1993, DATE '1993-04-11'), (1994, DATE '1994-04-03'),
  (1995, DATE '1995-04-16'), (1996, DATE '1996-04-07'), (1997, DATE '1997-03-30'), (1998, DATE '1998-04-12'),
  (1999, DATE '1999-04-04'), (2000, DATE '2000-04-23'), (2001, DATE '2001-04-15'), (2002, DATE '2002-03-31'),
  (2003, DATE '2003-04-20'))"""
LABEL = """CASE WHEN {d} BETWEEN sunday - 9 AND sunday - 1 THEN 'Semana Santa'
  WHEN month({d}) = 8 AND day({d}) BETWEEN 15 AND 22 THEN 'Feria de Málaga'
  WHEN month({d}) = 6 AND day({d}) = 23 THEN 'Noche de San Juan'
  WHEN month({d}) IN (6, 7, 8) THEN 'Verano'
  WHEN strftime({d}, '%m-%d') >= '12-20' OR strftime({d}, '%m-%d') <= '01-06' THEN 'Navidad/Reyes'
  ELSE 'Temporada normal' END"""


def days(t: Tables) -> DataFrame:
    return t.orders.selectExpr(*DAYS)


def daily(t: Tables) -> DataFrame:
    return A.rate_by(days(t), ["day"], F.col("booked"))


@query("rate_by_key", DAILY + " SELECT CAST(day AS VARCHAR) AS day, round(rate, 6) AS rate FROM r")
def rate_by_key(t: Tables) -> DataFrame:
    return daily(t).select(text("day").alias("day"), r6("rate").alias("rate"))


def _moving(t: Tables, size: int) -> DataFrame:
    table = centred_means(daily(t), "day", "rate", {"ma": size})
    return table.select(text("day").alias("day"), r6("rate").alias("rate"), r6("ma").alias("ma"))


def _moving_sql(size: int, before: int, after: int) -> str:
    frame = f"OVER (ORDER BY day ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING)"
    return (
        DAILY + " SELECT CAST(day AS VARCHAR) AS day, round(rate, 6) AS rate, "
        f"round(CASE WHEN count(*) {frame} = {size} THEN avg(rate) {frame} END, 6) AS ma FROM r"
    )


@query("rolling_mean_7", _moving_sql(7, 3, 3))
def rolling_mean_7(t: Tables) -> DataFrame:
    return _moving(t, 7)


@query("rolling_mean_30", _moving_sql(30, 15, 14))
def rolling_mean_30(t: Tables) -> DataFrame:
    return _moving(t, 30)


@query(
    "occupancy_trend",
    DAILY
    + """ SELECT CAST(day AS VARCHAR) AS day, round(rate, 6) AS rate,
    round(CASE WHEN count(*) OVER w7 = 7 THEN avg(rate) OVER w7 END, 6) AS ma7,
    round(CASE WHEN count(*) OVER w30 = 30 THEN avg(rate) OVER w30 END, 6) AS ma30 FROM r
    WINDOW w7 AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
           w30 AS (ORDER BY day ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)""",
)
def occupancy_trend(t: Tables) -> DataFrame:
    """The flagship: daily rate with its 7- and 30-row centred averages."""
    table = centred_means(daily(t), "day", "rate", {"ma7": 7, "ma30": 30})
    return table.select(text("day").alias("day"), *[r6(c).alias(c) for c in ("rate", "ma7", "ma30")])


@query(
    "mean_ci",
    WITH
    + """, w AS (SELECT CAST(isodow(day) - 1 AS INT) AS weekday, avg(CAST(booked AS DOUBLE)) AS mean,
      stddev_samp(CAST(booked AS DOUBLE)) / sqrt(count(*)) AS sem FROM d GROUP BY 1)
    SELECT weekday, round(mean, 6) AS mean, round(sem, 6) AS sem, round(1.96 * sem, 6) AS ci95 FROM w""",
)
def mean_ci(t: Tables) -> DataFrame:
    table = A.mean_ci(days(t).withColumn("weekday", D.weekday(F.col("day"))), "weekday", F.col("booked"))
    return table.select("weekday", *[r6(c).alias(c) for c in ("mean", "sem", "ci95")])


@query(
    "peak_key",
    DAILY + " SELECT CAST(day AS VARCHAR) AS day, round(rate, 6) AS rate FROM r ORDER BY r.rate DESC, r.day LIMIT 1",
)
def peak_key(t: Tables) -> DataFrame:
    return A.peak_key(daily(t), "day", "rate").select(text("day").alias("day"), r6("rate").alias("rate"))


@query(
    "pivot_mean",
    WITH
    + " SELECT CAST(month(day) AS INT) AS month, "
    + ", ".join(
        f"round(avg(CAST(booked AS DOUBLE)) FILTER (isodow(day) = {i + 1}), 6) AS d{i}" for i in range(7)
    )
    + " FROM d GROUP BY 1",
)
def pivot_mean(t: Tables) -> DataFrame:
    df = days(t).withColumns({"month": F.month("day"), "weekday": D.weekday(F.col("day"))})
    table = A.pivot_mean(df, "month", "weekday", range(7), F.col("booked"))
    return table.select("month", *[r6(F.col(f"`{i}`")).alias(f"d{i}") for i in range(7)])


@query(
    "segment_diff",
    WITH
    + """, m AS (SELECT CAST(month(day) AS INT) AS month,
      avg(CAST(booked AS DOUBLE)) FILTER (isodow(day) >= 6) AS weekend,
      avg(CAST(booked AS DOUBLE)) FILTER (isodow(day) < 6) AS workday FROM d GROUP BY 1)
    SELECT month, round(weekend, 6) AS weekend, round(workday, 6) AS workday, round(weekend - workday, 6) AS diff FROM m""",
)
def segment_diff(t: Tables) -> DataFrame:
    df = days(t).withColumn("month", F.month("day"))
    table = A.segment_diff(df, "month", D.is_weekend(F.col("day")), F.col("booked"), "weekend", "workday")
    return table.select("month", *[r6(c).alias(c) for c in ("weekend", "workday", "diff")])


@query(
    "mean_of_means",
    WITH
    + """, m AS (SELECT day, avg(o_totalprice) AS v FROM d GROUP BY day)
    SELECT CAST(month(day) AS INT) AS month, round(avg(v), 4) AS mean FROM m GROUP BY 1""",
)
def mean_of_means(t: Tables) -> DataFrame:
    df = days(t).withColumn("month", F.month("day"))
    table = A.mean_of_means(df, ["month", "day"], "month", F.col("o_totalprice"))
    return table.select("month", F.round("mean", 4).alias("mean"))


@query(
    "event_label",
    f"WITH {EASTER} SELECT o_orderkey, {LABEL.format(d='o_orderdate')} AS event "
    "FROM orders JOIN easter ON year(o_orderdate) = y",
)
def event_label(t: Tables) -> DataFrame:
    return days(t).select("o_orderkey", D.event_label(F.col("day")).alias("event"))


@query(
    "event_stats",
    WITH
    + f""", {EASTER}, e AS (SELECT d.*, {LABEL.format(d='day')} AS event FROM d JOIN easter ON year(day) = y)
    SELECT event, round(avg(CAST(booked AS DOUBLE)), 6) AS occupancy, round(avg(min_nights), 6) AS min_nights,
      round(avg(max_nights), 6) AS max_nights, count(*) AS n FROM e GROUP BY event""",
)
def event_stats(t: Tables) -> DataFrame:
    df = days(t).withColumn("event", D.event_label(F.col("day")))
    means = {"occupancy": F.col("booked"), "min_nights": F.col("min_nights"), "max_nights": F.col("max_nights")}
    table = A.event_stats(df, "event", means, F.col("booked"), "occupancy")
    return table.select("event", *[r6(c).alias(c) for c in means], "n")


@query(
    "interval_join",
    DAILY
    + f""", {EASTER}, y AS (SELECT DISTINCT year(day) AS y FROM r),
    w AS (SELECT 'Feria de Málaga' AS event, make_date(y, 8, 15) AS a, make_date(y, 8, 22) AS b FROM y
      UNION ALL SELECT 'Puente de diciembre', make_date(y, 12, 6), make_date(y, 12, 8) FROM y
      UNION ALL SELECT 'Zambombas flamencas', make_date(y, 12, 12), make_date(y, 12, 19) FROM y
      UNION ALL SELECT 'Navidad', make_date(y, 12, 20), make_date(y + 1, 1, 6) FROM y
      UNION ALL SELECT 'Noche de San Juan', make_date(y, 6, 23), make_date(y, 6, 23) FROM y
      UNION ALL SELECT 'Semana Santa', sunday - 9, sunday - 1 FROM y JOIN easter USING (y))
    SELECT CAST(day AS VARCHAR) AS day, event, round(rate, 6) AS rate FROM r JOIN w ON day BETWEEN a AND b""",
)
def interval_join_query(t: Tables) -> DataFrame:
    table = daily(t)
    windows = event_windows(table.select(F.year("day").alias("year")).distinct())
    joined = interval_join(table, "day", windows)
    return joined.select(text("day").alias("day"), "event", r6("rate").alias("rate"))


@query(
    "range_join_minutes",
    """WITH w AS (SELECT event_id AS window_id, user_id AS buyer, ts AS opens, ts + INTERVAL 10 MINUTE AS closes
      FROM events WHERE event_type = 'purchase')
    SELECT window_id, buyer, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 6) AS value
    FROM events JOIN w ON ts BETWEEN opens AND closes GROUP BY window_id, buyer""",
)
def range_join_minutes(t: Tables) -> DataFrame:
    """What happens in the ten minutes from each purchase on, from running totals: no row for each pair is made."""
    bought = t.events.where("event_type = 'purchase'")
    windows = bought.selectExpr("event_id AS window_id", "user_id AS buyer", "ts AS opens", "ts + INTERVAL 10 MINUTES AS closes")
    found = totals_after(t.events, "ts", windows.drop("closes"), 600, {"value": "value"}, {"users": "user_id"}, "opens")
    keys = ["window_id", "buyer"]
    sums = found.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("users").alias("users"), F.sum("value").alias("value"))
    # an id that came more than once, or none, has many windows: the users of all of them together are looked up
    shared = windows.groupBy(*keys).agg(F.min("opens").alias("a"), F.max("opens").alias("b")).where("a < b").select(F.struct(*keys).alias("key"))
    joint = windows.withColumn("key", F.struct(*keys)).join(shared, "key", "left_semi").select("key", "opens", "closes")
    users = range_join(t.events.select("ts", "user_id"), "ts", joint, [600], "opens", "closes").groupBy("key").agg(F.count_distinct("user_id").alias("together"))
    sums = attach_by_key(sums.withColumn("key", F.struct(*keys)), users, ["key"])
    return sums.select(*keys, "n", F.coalesce("together", "users").alias("users"), r6("value").alias("value"))


SEASON = (
    "n_nationkey AS season",
    "make_date(CAST(1995 + n_nationkey % 6 AS INT), CAST(1 + n_nationkey % 12 AS INT), 1) AS opens",
    "make_date(CAST(1995 + n_nationkey % 6 + n_nationkey % 3 AS INT), CAST(1 + n_nationkey % 12 AS INT), CAST(1 + n_nationkey AS INT)) AS closes",
)


@query(
    "range_join_years",
    f"""WITH w AS ({shaped('nation', SEASON)}), d AS (SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT season, count(*) AS n, round(avg(o_totalprice), 6) AS price, CAST(min(day) AS VARCHAR) AS first_day
    FROM d JOIN w ON day BETWEEN opens AND closes GROUP BY season""",
)
def range_join_years(t: Tables) -> DataFrame:
    """Orders in seasons of some days to two years, which overlap; bins of a month, a quarter and a year."""
    windows = t.nation.selectExpr(*SEASON)
    orders = t.orders.selectExpr("o_orderkey", "o_totalprice", "CAST(o_orderdate AS DATE) AS day")
    found = range_join(orders, "day", windows, [30, 90, 365], "opens", "closes")
    sums = found.groupBy("season").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("price"), F.min("day").alias("day"))
    return sums.select("season", "n", r6("price").alias("price"), text("day").alias("first_day"))


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
    CAST(isodow(o_orderdate) - 1 AS INT) AS weekday, isodow(o_orderdate) IN (6, 7) AS weekend,
    strftime(o_orderdate, '%Y-%m-01') AS month_start FROM orders""",
)
def date_parts(t: Tables) -> DataFrame:
    day = F.col("day")
    return days(t).select(
        "o_orderkey",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        D.weekday(day).alias("weekday"),
        D.is_weekend(day).alias("weekend"),
        text(D.month_start(day)).alias("month_start"),
    )


@query(
    "days_since",
    """SELECT o_orderkey, CAST(coalesce(date_diff('day', CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END,
    DATE '2002-01-01'), 0) AS INT) AS days FROM orders""",
)
def days_since(t: Tables) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 7 != 0, F.col("day"))
    return days(t).select("o_orderkey", D.days_since(day, F.lit("2002-01-01").cast("date")).alias("days"))


@query(
    "days_since_max",
    """SELECT o_orderkey, CAST(coalesce(date_diff('day', CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END,
    (SELECT CAST(max(o_orderdate) AS DATE) FROM orders WHERE o_orderkey % 7 <> 0)), 0) AS INT) AS days FROM orders""",
)
def days_since_max(t: Tables) -> DataFrame:
    df = days(t).withColumn("last", F.when(F.col("o_orderkey") % 7 != 0, F.col("day")))
    latest = one_row(df, day=F.coalesce(F.max("last"), F.current_date()))["day"]
    return df.select("o_orderkey", D.days_since(F.col("last"), latest).alias("days"))


@query(
    "counts_by_year",
    "SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n FROM orders GROUP BY 1",
)
def counts_by_year(t: Tables) -> DataFrame:
    return A.counts_by_year(days(t), "day")


@query(
    "kpis",
    WITH
    + """ SELECT count(*) AS n_rows, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day,
    round(avg(CAST(booked AS DOUBLE)), 6) AS rate,
    round(avg(CAST(booked AS DOUBLE)) FILTER (isodow(day) >= 6), 6) AS weekend_rate,
    round(avg(CAST(booked AS DOUBLE)) FILTER (isodow(day) < 6), 6) AS workday_rate,
    count(DISTINCT o_custkey) AS n_customers FROM d""",
)
def kpis(t: Tables) -> DataFrame:
    booked, weekend = F.col("booked").cast("double"), D.is_weekend(F.col("day"))
    return days(t).agg(
        F.count(F.lit(1)).alias("n_rows"),
        text(F.min("day")).alias("first_day"),
        text(F.max("day")).alias("last_day"),
        r6(F.avg(booked)).alias("rate"),
        r6(F.avg(F.when(weekend, booked))).alias("weekend_rate"),
        r6(F.avg(F.when(~weekend, booked))).alias("workday_rate"),
        F.count_distinct("o_custkey").alias("n_customers"),
    )


@query(
    "t_test",
    WITH
    + """, s AS (SELECT CAST(booked AS DOUBLE) AS x, isodow(day) >= 6 AS g FROM d),
    a AS (SELECT count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n0, avg(x) FILTER (g) AS m1, avg(x) FILTER (NOT g) AS m0,
      var_samp(x) FILTER (g) AS v1, var_samp(x) FILTER (NOT g) AS v0 FROM s),
    b AS (SELECT *, n1 + n0 - 2 AS df, (m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)
      * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n0)) AS t FROM a),
    -- Two-sided p: trapezoid rule over the density, in twenty thousand steps from 0 to |t|.
    p AS (SELECT 1 - 2 * sum(CASE WHEN i IN (0, 20000) THEN 0.5 ELSE 1 END
        * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0) - (df + 1) / 2.0 * ln(1 + pow(abs(t) * i / 20000, 2) / df))
        / sqrt(pi() * df)) * max(abs(t)) / 20000 AS p FROM b, range(20001) r(i))
    SELECT n1, n0, df, round(m1, 6) AS mean1, round(m0, 6) AS mean0, round(t, 6) AS t, round(p, 5) AS p FROM b, p""",
)
def t_test(t: Tables) -> DataFrame:
    table = A.two_sample_t(days(t), D.is_weekend(F.col("day")), F.col("booked"))
    return table.select("n1", "n0", "df", *[r6(c).alias(c) for c in ("mean1", "mean0", "t")], F.round("p", 5).alias("p"))


@query(
    "coverage_anomalies",
    WITH
    + """, n AS (SELECT day, count(DISTINCT o_custkey) AS n FROM d GROUP BY day)
    SELECT CAST(day AS VARCHAR) AS day, n, (SELECT median(n) FROM n) AS expected FROM n
    WHERE n < 0.5 * (SELECT median(n) FROM n)""",
)
def coverage_anomalies(t: Tables) -> DataFrame:
    table = A.coverage_anomalies(days(t), "day", "o_custkey")
    return table.select(text("day").alias("day"), "n", "expected")


DATE_TEXT = (
    "CASE WHEN o_orderkey % 7 = 0 THEN '2025-13-01' WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 "
    "THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date_text"
)


@query(
    "parse_date",
    f"WITH o AS (SELECT o_orderkey, {DATE_TEXT} FROM orders) "
    "SELECT o_orderkey, CAST(try_cast(date_text AS DATE) AS VARCHAR) AS day FROM o",
)
def parse_date(t: Tables) -> DataFrame:
    df = t.orders.selectExpr("o_orderkey", DATE_TEXT)
    return df.select("o_orderkey", text(C.parse_date(F.col("date_text"))).alias("day"))


@query(
    "date_sanity",
    WITH
    + """, p AS (SELECT o_orderkey, CASE WHEN day <= DATE '2000-06-30' THEN day END AS a,
      CASE WHEN CAST(day + CAST(o_orderkey % 40 - 10 AS INT) AS DATE) <= DATE '2000-06-30'
      THEN CAST(day + CAST(o_orderkey % 40 - 10 AS INT) AS DATE) END AS b FROM d)
    SELECT o_orderkey, CAST(CASE WHEN coalesce(a > b, false) THEN NULL ELSE a END AS VARCHAR) AS first_day,
      CAST(CASE WHEN coalesce(a > b, false) THEN NULL ELSE b END AS VARCHAR) AS last_day FROM p""",
)
def date_sanity(t: Tables) -> DataFrame:
    limit = F.lit("2000-06-30").cast("date")
    later = F.date_add("day", (F.col("o_orderkey") % 40 - 10).cast("int"))
    first, last = C.ordered_pair(C.not_after(F.col("day"), limit), C.not_after(later, limit))
    return days(t).select("o_orderkey", text(first).alias("first_day"), text(last).alias("last_day"))
