"""Single-value cleaning and features, on orders, customers and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import clean as C
from lodgeframe.functions import features as X
from lodgeframe.operators import tables as O
from lodgeframe.queries.registry import Tables, query, r6, shaped, text

AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
GROUPED = (
    f"CASE WHEN o_totalprice >= 1000 THEN concat(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING), ',', "
    f"right({AMOUNT}, 6)) ELSE {AMOUNT} END"
)
ORDERS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    f"CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'n/a' "
    f"WHEN o_orderkey % 5 = 0 THEN concat('€', {AMOUNT}) ELSE concat('$', {GROUPED}) END AS price_text",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 17 = 0 "
    "THEN '150%' ELSE concat(CAST(o_orderkey % 101 AS STRING), '%') END AS rate_text",
    "CASE WHEN o_orderstatus = 'F' THEN 't' WHEN o_orderstatus = 'O' THEN 'f' "
    "WHEN o_orderkey % 3 = 0 THEN 'x' END AS flag_text",
    f"CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'junk' WHEN o_orderkey % 13 = 0 "
    f"THEN '1d' ELSE {AMOUNT} END AS number_text",
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price7",
    "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey % 101 AS DOUBLE) / 100 END AS rate9",
    "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE CAST(o_orderkey % 51 AS DOUBLE) / 10 END AS rating8",
    "CAST(o_orderkey % 23 AS INT) AS n_reviews",
]
SHAPED = f"WITH o AS ({shaped('orders', ORDERS)}) "


def orders(t: Tables) -> DataFrame:
    return t.orders.selectExpr(*ORDERS)


@query(
    "clean_currency",
    SHAPED + "SELECT o_orderkey, try_cast(regexp_replace(price_text, '[$,%€]', '', 'g') AS DOUBLE) AS price FROM o",
)
def clean_currency(t: Tables) -> DataFrame:
    return orders(t).select("o_orderkey", C.clean_currency(F.col("price_text")).alias("price"))


@query(
    "clean_rate",
    SHAPED
    + """, r AS (SELECT o_orderkey, try_cast(replace(rate_text, '%', '') AS DOUBLE) AS v FROM o)
    SELECT o_orderkey, CASE WHEN v BETWEEN 0 AND 100 THEN v END AS rate,
           CASE WHEN v BETWEEN 0 AND 100 THEN v END / 100 AS share FROM r""",
)
def clean_rate(t: Tables) -> DataFrame:
    rate = C.clean_rate(F.col("rate_text"))
    return orders(t).select("o_orderkey", rate.alias("rate"), (rate / F.lit(100.0)).alias("share"))


@query(
    "map_bool",
    SHAPED
    + """SELECT o_orderkey, CAST(CASE WHEN flag_text IN ('t', 'true', '1') THEN true
    WHEN flag_text IN ('f', 'false', '0') THEN false END AS VARCHAR) AS flag FROM o""",
)
def map_bool(t: Tables) -> DataFrame:
    return orders(t).select("o_orderkey", text(C.map_bool(F.col("flag_text"))).alias("flag"))


@query("bool_eq", SHAPED + "SELECT o_orderkey, coalesce(flag_text = 't', false) AS flag FROM o")
def bool_eq(t: Tables) -> DataFrame:
    return orders(t).select("o_orderkey", C.bool_eq(F.col("flag_text")).alias("flag"))


@query(
    "zero_to_null",
    "SELECT o_orderkey, nullif(CAST(o_orderkey % 5 AS DOUBLE), 0) AS value FROM orders",
)
def zero_to_null(t: Tables) -> DataFrame:
    value = (F.col("o_orderkey") % 5).cast("double")
    return t.orders.select("o_orderkey", C.zero_to_null(value).alias("value"))


@query(
    "clip",
    SHAPED
    + """SELECT o_orderkey, CASE WHEN price7 IS NOT NULL THEN greatest(50000, least(300000, price7)) END AS both_ends,
    CASE WHEN price7 IS NOT NULL THEN least(300000, price7) END AS upper_end FROM o""",
)
def clip(t: Tables) -> DataFrame:
    price = F.col("price7")
    return orders(t).select(
        "o_orderkey",
        C.clip(price, 50000.0, 300000.0).alias("both_ends"),
        C.clip(price, hi=300000.0).alias("upper_end"),
    )


@query(
    "log1p_cols",
    SHAPED + "SELECT o_orderkey, round(ln(1 + price7), 6) AS price7_log, round(ln(1 + n_reviews), 6) AS n_reviews_log FROM o",
)
def log1p_cols(t: Tables) -> DataFrame:
    out = O.log1p_columns(orders(t), ["price7", "n_reviews", "absent"])
    return out.select("o_orderkey", r6("price7_log").alias("price7_log"), r6("n_reviews_log").alias("n_reviews_log"))


@query(
    "to_numeric_range",
    SHAPED
    + """, n AS (SELECT o_orderkey, try_cast(number_text AS DOUBLE) AS v FROM o)
    SELECT o_orderkey, v AS number, CASE WHEN v BETWEEN 100000 AND 400000 THEN v END AS in_range FROM n""",
)
def to_numeric_range(t: Tables) -> DataFrame:
    number = F.col("number_text")
    return orders(t).select(
        "o_orderkey",
        C.to_number(number).alias("number"),
        C.to_numeric_range(number, 100000.0, 400000.0).alias("in_range"),
    )


@query(
    "cond_assign",
    SHAPED
    + "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND price7 IS NULL THEN 1 ELSE price7 END AS price FROM o",
)
def cond_assign(t: Tables) -> DataFrame:
    gap = (F.col("o_orderstatus") == "P") & F.col("price7").isNull()
    return orders(t).select("o_orderkey", C.cond_assign(F.col("price7"), gap, F.lit(1.0)).alias("price"))


@query(
    "fill_expr",
    SHAPED
    + """SELECT o_orderkey, coalesce(price7, 0) AS constant, coalesce(price7, CAST(o_custkey AS DOUBLE) * 2) AS expression
    FROM o""",
)
def fill_expr(t: Tables) -> DataFrame:
    price = F.col("price7")
    return orders(t).select(
        "o_orderkey",
        C.fill(price, 0.0).alias("constant"),
        C.fill(price, F.col("o_custkey").cast("double") * 2).alias("expression"),
    )


@query(
    "override_by_id",
    """SELECT o_orderkey, CASE WHEN o_orderkey IN (1, 5, 9, 700) THEN 182 ELSE o_totalprice END AS by_list,
    CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') THEN 0
    ELSE o_totalprice END AS by_table FROM orders""",
)
def override_by_id(t: Tables) -> DataFrame:
    chosen = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    df = t.orders.select("o_orderkey", "o_custkey", *[F.col("o_totalprice").alias(c) for c in ("by_list", "by_table")])
    df = O.override_by_id(df, "o_orderkey", [1, 5, 9, 700], "by_list", 182.0)
    return O.override_by_id(df, "o_custkey", chosen, "by_table", 0.0).drop("o_custkey")


@query(
    "override_if_all_null",
    SHAPED
    + """, g AS (SELECT bool_and(price7 IS NULL) FILTER (o_orderkey IN (7, 14, 21)) AS a,
                     bool_and(price7 IS NULL) FILTER (o_orderkey IN (7, 8)) AS b FROM o)
    SELECT o_orderkey,
      CASE WHEN a AND o_orderkey = 7 THEN 1 WHEN a AND o_orderkey IN (14, 21) THEN 0 ELSE price7 END AS all_null,
      CASE WHEN b AND o_orderkey IN (7, 8) THEN 1 ELSE price7 END AS not_all_null FROM o, g""",
)
def override_if_all_null(t: Tables) -> DataFrame:
    df = orders(t).select("o_orderkey", *[F.col("price7").alias(c) for c in ("all_null", "not_all_null")])
    df = O.override_if_all_null(df, "o_orderkey", {7: 1.0, 14: 0.0, 21: 0.0}, "all_null")
    return O.override_if_all_null(df, "o_orderkey", {7: 1.0, 8: 1.0}, "not_all_null")


@query(
    "reconcile_columns",
    SHAPED
    + """, p AS (SELECT o_orderkey, price7, CASE WHEN o_orderkey % 20 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS few,
                     CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS many FROM o),
    s AS (SELECT avg(CASE WHEN price7 <> few THEN 1.0 ELSE 0 END) AS a,
                 avg(CASE WHEN price7 <> many THEN 1.0 ELSE 0 END) AS b FROM p)
    SELECT o_orderkey, CASE WHEN a < 0.1 THEN few ELSE coalesce(price7, few) END AS adopted,
           CASE WHEN b < 0.1 THEN many ELSE coalesce(price7, many) END AS filled FROM p, s""",
)
def reconcile_columns(t: Tables) -> DataFrame:
    total = F.col("o_totalprice")
    df = orders(t).select(
        "o_orderkey",
        "price7",
        F.when(F.col("o_orderkey") % 20 == 0, total + 1).otherwise(total).alias("few"),
        F.when(F.col("o_orderkey") % 4 == 0, total + 1).otherwise(total).alias("many"),
    )
    df = O.reconcile_columns(df, "price7", "few", "adopted")
    return O.reconcile_columns(df, "price7", "many", "filled").select("o_orderkey", "adopted", "filled")


@query(
    "revenue_estimate",
    SHAPED
    + """SELECT o_orderkey, round(greatest(price7 * (o_orderkey % 366 - 10), CASE WHEN price7 IS NOT NULL THEN 0 END), 4) AS last_year,
    round(price7 * (365 - o_orderkey % 366), 4) AS next_year FROM o""",
)
def revenue_estimate(t: Tables) -> DataFrame:
    days = F.col("o_orderkey") % 366
    return orders(t).select(
        "o_orderkey",
        F.round(X.revenue(F.col("price7"), days - 10), 4).alias("last_year"),
        F.round(X.revenue(F.col("price7"), F.lit(365) - days), 4).alias("next_year"),
    )


@query(
    "tri_state_rule",
    SHAPED
    + """SELECT o_orderkey, CASE WHEN flag_text = 't' THEN true WHEN flag_text = 'f' THEN false
      WHEN price7 > 200000 AND rate9 >= 0.5 AND rating8 >= 2 THEN true
      WHEN price7 <= 200000 OR rate9 < 0.5 OR rating8 < 2 THEN false ELSE true END AS status FROM o""",
)
def tri_state_rule(t: Tables) -> DataFrame:
    price, rate, rating = F.col("price7"), F.col("rate9"), F.col("rating8")
    status = C.tri_state(
        C.map_bool(F.col("flag_text")),
        (price > 200000) & (rate >= 0.5) & (rating >= 2),
        (price <= 200000) | (rate < 0.5) | (rating < 2),
        F.lit(True),
    )
    return orders(t).select("o_orderkey", status.alias("status"))


@query(
    "status_rule",
    SHAPED
    + """SELECT o_orderkey, coalesce(CASE flag_text WHEN 't' THEN true WHEN 'f' THEN false END,
      coalesce(n_reviews >= 10 AND rate9 >= 0.4 AND rate9 + 0.1 >= 0.4 AND rating8 >= 2.5, false)) AS status FROM o""",
)
def status_rule(t: Tables) -> DataFrame:
    rate = F.col("rate9")
    status = X.status_rule(
        C.map_bool(F.col("flag_text")), F.col("n_reviews"), rate, rate + 0.1, F.col("rating8"),
        rate_threshold=0.4, min_rating=2.5,
    )
    return orders(t).select("o_orderkey", status.alias("status"))


@query(
    "presence_flags",
    SHAPED
    + """SELECT o.o_orderkey, CAST(coalesce(n_reviews > 0, false) AS INT) AS has_review,
      CAST(year(d.o_orderdate) = 1998 AS INT) AS reviewed_1998,
      CAST(year(d.o_orderdate) = 1998 OR n_reviews > 20 AS INT) AS reviewed_1998_or_counted,
      coalesce(o.o_orderkey % 500 > 365, false) AS long_stay
      FROM o JOIN orders d ON o.o_orderkey = d.o_orderkey""",
)
def presence_flags(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(*ORDERS, "CAST(o_orderdate AS DATE) AS last_review")
    return df.select(
        "o_orderkey",
        X.has_review(F.col("n_reviews")).alias("has_review"),
        X.reviewed_in(F.col("last_review"), 1998).alias("reviewed_1998"),
        X.reviewed_in(F.col("last_review"), 1998, F.col("n_reviews") - 20).alias("reviewed_1998_or_counted"),
        X.long_stay(F.col("o_orderkey") % 500).alias("long_stay"),
    )


@query(
    "safe_ratio",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_linenumber > 1 THEN l_extendedprice / (l_linenumber - 1)
    ELSE 0 END, 6) AS ratio FROM lineitem""",
)
def safe_ratio(t: Tables) -> DataFrame:
    ratio = X.safe_ratio(F.col("l_extendedprice"), F.col("l_linenumber") - 1)
    return t.lineitem.select("l_orderkey", "l_linenumber", r6(ratio).alias("ratio"))


@query(
    "round_half_even",
    """SELECT l_orderkey, l_linenumber, round_even(l_quantity * 0.125, 2) AS two, round_even(l_quantity * 0.25, 1) AS one,
    round_even(l_quantity * 0.5, 0) AS zero FROM lineitem""",
)
def round_half_even(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        C.round_half_even(q * 0.125, 2).alias("two"),
        C.round_half_even(q * 0.25, 1).alias("one"),
        C.round_half_even(q * 0.5, 0).alias("zero"),
    )


@query(
    "haversine",
    """WITH c AS (SELECT c_custkey, radians(36.3 + (c_custkey % 100) / 100.0) AS lat,
      radians(-5.5 + (c_custkey % 170) / 100.0) AS lon, radians(36.7213) AS lat0, radians(-4.4214) AS lon0 FROM customer)
    SELECT c_custkey, round(6371.0 * 2 * asin(sqrt(sin((lat0 - lat) / 2) * sin((lat0 - lat) / 2)
      + cos(lat) * cos(lat0) * sin((lon0 - lon) / 2) * sin((lon0 - lon) / 2))), 6) AS km FROM c""",
)
def haversine(t: Tables) -> DataFrame:
    lat = F.lit(36.3) + (F.col("c_custkey") % 100) / 100.0
    lon = F.lit(-5.5) + (F.col("c_custkey") % 170) / 100.0
    km = X.haversine_km(lat, lon, F.lit(36.7213), F.lit(-4.4214))
    return t.customer.select("c_custkey", r6(km).alias("km"))


@query(
    "trust_score",
    """SELECT c_custkey, round(coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END, 0) * ln(1 + c_custkey % 50), 6) AS score,
    round(CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END * ln(1 + c_custkey % 50), 6) AS score_or_null FROM customer""",
)
def trust_score(t: Tables) -> DataFrame:
    rating = F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal"))
    reviews = F.col("c_custkey") % 50
    return t.customer.select(
        "c_custkey",
        r6(X.trust_score(rating, reviews)).alias("score"),
        r6(X.trust_score(rating, reviews, missing_as_zero=False)).alias("score_or_null"),
    )


@query(
    "segment_count",
    """WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 8 END AS v FROM customer)
    SELECT c_custkey, CASE WHEN v = 1 THEN 'Individual' WHEN v < 5 THEN 'Small_Investor' ELSE 'Agency' END AS below_five,
      CASE WHEN v = 1 THEN 'Individual' WHEN v <= 5 THEN 'Small_Investor' ELSE 'Agency' END AS up_to_five FROM n""",
)
def segment_count(t: Tables) -> DataFrame:
    count = F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey") % 8)
    return t.customer.select(
        "c_custkey",
        X.segment_count(count).alias("below_five"),
        X.segment_count(count, small_below=6).alias("up_to_five"),
    )


@query(
    "company_flag",
    """WITH h AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN concat(c_name, ' Rentals') WHEN c_custkey % 10 = 1
      THEN 'Rosalia' ELSE c_name END AS host, c_custkey % 9 AS total FROM customer)
    SELECT c_custkey, CAST(regexp_matches(lower(host), '\\b(sl|sa|rentals)\\b') OR total >= 5 AS INT) AS by_word,
      CAST(regexp_matches(lower(host), 'sl|sa|rentals') OR total >= 5 AS INT) AS by_part FROM h""",
)
def company_flag(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    host = F.when(key % 10 == 0, F.concat("c_name", F.lit(" Rentals"))).when(key % 10 == 1, "Rosalia")
    host = host.otherwise(F.col("c_name"))
    return t.customer.select(
        "c_custkey",
        X.company_flag(host, key % 9, "sl|sa|rentals").alias("by_word"),
        X.company_flag(host, key % 9, "sl|sa|rentals", whole_word=False).alias("by_part"),
    )


@query(
    "map_lookup",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 0 END::DOUBLE AS code,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'site' ELSE 'other' END AS label FROM customer""",
)
def map_lookup(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey",
        C.map_lookup(segment, {"BUILDING": 1.0, "MACHINERY": 0.0}).alias("code"),
        C.map_lookup(segment, {"BUILDING": "site"}, F.lit("other")).alias("label"),
    )


@query(
    "residual_count",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 - o_orderkey % 4 - o_orderkey % 3 < 0 THEN 0
    ELSE o_orderkey % 10 - o_orderkey % 4 - o_orderkey % 3 END AS rest FROM orders""",
)
def residual_count(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    rest = X.residual_count(key % 10, [key % 4, key % 3])
    return t.orders.select("o_orderkey", rest.cast("bigint").alias("rest"))
