"""Group statistics, imputation and lookups, on customers, nations and parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import clean as C
from lodgeframe.functions import text as X
from lodgeframe.operators import aggregates as A
from lodgeframe.operators import encode as E
from lodgeframe.operators import impute as I
from lodgeframe.operators import lookups as L
from lodgeframe.operators import tables as O
from lodgeframe.queries.registry import Tables, query, r6, shaped

CUSTOMERS = [
    "c_custkey",
    "c_name",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS nation",
    "CASE WHEN c_custkey % 7 = 0 OR c_nationkey = 3 THEN NULL ELSE c_acctbal END AS balance",
    "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment",
]
WITH = f"WITH c AS ({shaped('customer', CUSTOMERS)})"


def customers(t: Tables) -> DataFrame:
    return t.customer.selectExpr(*CUSTOMERS)


@query(
    "impute_median",
    WITH
    + """, m AS (SELECT nation, median(balance) AS m FROM c WHERE nation IS NOT NULL GROUP BY nation)
    SELECT c_custkey, round(coalesce(balance, m), 6) AS balance FROM c LEFT JOIN m USING (nation)""",
)
def impute_median(t: Tables) -> DataFrame:
    df = I.impute_median(customers(t), "balance", "nation")
    return df.select("c_custkey", r6("balance").alias("balance"))


@query(
    "impute_mode",
    WITH
    + """, n AS (SELECT nation, segment, row_number() OVER (PARTITION BY nation ORDER BY count(*) DESC, segment) AS r
      FROM c WHERE nation IS NOT NULL AND segment IS NOT NULL GROUP BY nation, segment)
    SELECT c_custkey, coalesce(c.segment, n.segment) AS segment FROM c LEFT JOIN n ON c.nation = n.nation AND r = 1""",
)
def impute_mode(t: Tables) -> DataFrame:
    return I.impute_mode(customers(t), "segment", "nation").select("c_custkey", "segment")


def draw_sql(salt: str, key: str) -> str:
    """A standard normal number from two 32-bit parts of a digest."""
    digest = f"md5('{salt}|' || {key})"
    u = [f"((CAST('0x' || substr({digest}, {i}, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)" for i in (1, 9)]
    return f"(sqrt(-2 * ln({u[0]})) * cos(2 * pi() * {u[1]}))"


@query(
    "impute_median_noise",
    WITH
    + f""", m AS (SELECT nation, segment, median(balance) AS m, stddev_samp(balance) AS s FROM c
      WHERE nation IS NOT NULL AND segment IS NOT NULL GROUP BY nation, segment)
    SELECT c_custkey, round(coalesce(balance, m + CASE WHEN s IS NULL OR s = 0 THEN 0.05 ELSE s * 0.1 END
      * {draw_sql('42|balance', 'c_custkey')}), 4) AS balance FROM c LEFT JOIN m USING (nation, segment)""",
)
def impute_median_noise(t: Tables) -> DataFrame:
    df = I.impute_median(customers(t), "balance", ["nation", "segment"], I.Noise("c_custkey"))
    return df.select("c_custkey", F.round("balance", 4).alias("balance"))


@query(
    "impute_fallback_global",
    WITH
    + f""", m AS (SELECT nation, median(balance) AS m, stddev_samp(balance) AS s FROM c WHERE nation IS NOT NULL GROUP BY nation),
    f AS (SELECT c_custkey, coalesce(balance, CASE WHEN m IS NOT NULL THEN greatest(0, least(9000,
      m + coalesce(s, 5) * {draw_sql('42|balance', 'c_custkey')})) END) AS balance FROM c LEFT JOIN m USING (nation))
    SELECT c_custkey, round(coalesce(balance, (SELECT median(balance) FROM f)), 4) AS balance FROM f""",
)
def impute_fallback_global(t: Tables) -> DataFrame:
    noise = I.Noise("c_custkey", share=1.0, fallback=5.0, zero_is_unknown=False, bounds=(0.0, 9000.0))
    df = I.impute_median(customers(t), "balance", "nation", noise, global_fallback=True)
    return df.select("c_custkey", F.round("balance", 4).alias("balance"))


@query(
    "impute_fixed_noise",
    WITH
    + f""", m AS (SELECT nation, median(balance) AS m FROM c WHERE nation IS NOT NULL GROUP BY nation)
    SELECT c_custkey, round(coalesce(balance, m + 5 * {draw_sql('7|balance', 'c_custkey')}), 4) AS balance
    FROM c LEFT JOIN m USING (nation)""",
)
def impute_fixed_noise(t: Tables) -> DataFrame:
    df = I.impute_median(customers(t), "balance", "nation", I.Noise("c_custkey", fixed=5.0, seed=7))
    return df.select("c_custkey", F.round("balance", 4).alias("balance"))


@query(
    "group_transform",
    WITH
    + """, g AS (SELECT nation, sum(balance) AS s, avg(balance) AS m FROM c WHERE nation IS NOT NULL GROUP BY nation)
    SELECT c_custkey, round(s, 4) AS total, round(m, 4) AS mean FROM c LEFT JOIN g USING (nation)""",
)
def group_transform(t: Tables) -> DataFrame:
    df = I.group_transform(customers(t), "nation", total=F.sum("balance"), mean=F.avg("balance"))
    return df.select("c_custkey", F.round("total", 4).alias("total"), F.round("mean", 4).alias("mean"))


@query(
    "group_median_topn",
    WITH
    + """ SELECT CAST(nation AS INT) AS nation, round(median(balance), 4) AS median, round(avg(balance), 4) AS mean,
      min(balance) AS "min", max(balance) AS "max" FROM c WHERE nation IS NOT NULL GROUP BY nation
    ORDER BY median(balance) DESC NULLS LAST, nation LIMIT 15""",
)
def group_median_topn(t: Tables) -> DataFrame:
    table = A.group_median_topn(customers(t), "nation", "balance", 15)
    return table.select("nation", F.round("median", 4).alias("median"), F.round("mean", 4).alias("mean"), "min", "max")


@query(
    "lookup_join",
    WITH
    + """ SELECT c_custkey, n_name, CAST(n_regionkey AS DOUBLE) AS n_regionkey FROM c
    LEFT JOIN nation n ON c.nation = n_nationkey""",
)
def lookup_join(t: Tables) -> DataFrame:
    nations = t.nation.withColumnRenamed("n_nationkey", "nation")
    return L.lookup_join(customers(t), nations, "nation").select(
        "c_custkey", "n_name", F.col("n_regionkey").cast("double").alias("n_regionkey")
    )


@query(
    "agg_join_back",
    """SELECT c_custkey, coalesce(n, 0) AS n_orders, coalesce(s, 0) AS spent FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n,
      round(sum(o_totalprice), 2) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def agg_join_back(t: Tables) -> DataFrame:
    facts = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    aggregates = {"n_orders": F.count(F.lit(1)), "spent": F.round(F.sum("o_totalprice"), 2)}
    return L.agg_join_back(t.customer.select("c_custkey"), facts, "c_custkey", aggregates)


@query(
    "value_counts",
    """SELECT c_mktsegment, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer)::DOUBLE, 6) AS share
    FROM customer GROUP BY c_mktsegment""",
)
def value_counts(t: Tables) -> DataFrame:
    table = A.value_counts(t.customer, "c_mktsegment", share=True)
    return table.select("c_mktsegment", "n", r6("share").alias("share"))


@query(
    "value_counts_with_nulls",
    WITH + " SELECT segment, count(*) AS n FROM c GROUP BY segment",
)
def value_counts_with_nulls(t: Tables) -> DataFrame:
    return A.value_counts(customers(t), "segment", nulls=True)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "ohe_scalar",
    WITH
    + " SELECT c_custkey, "
    + ", ".join(f"coalesce(segment = '{s}', false) AS segment_{s}" for s in SEGMENTS)
    + " FROM c",
)
def ohe_scalar(t: Tables) -> DataFrame:
    return E.one_hot(customers(t).select("c_custkey", "segment"), "segment").drop("segment")


@query(
    "drop_null_rows",
    WITH + " SELECT c_custkey, balance, segment FROM c WHERE balance IS NOT NULL AND segment IS NOT NULL",
)
def drop_null_rows(t: Tables) -> DataFrame:
    return O.drop_null_rows(customers(t), ["balance", "segment"]).select("c_custkey", "balance", "segment")


@query(
    "null_profile",
    WITH
    + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, round_even(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) * 100, 2) AS pct_null FROM c"
        for c in ("c_custkey", "c_name", "nation", "balance", "segment")
    ),
)
def null_profile(t: Tables) -> DataFrame:
    return A.null_profile(customers(t), top=15)


@query("drop_high_null", "SELECT c_custkey, c_name FROM customer")
def drop_high_null(t: Tables) -> DataFrame:
    rare = F.when(F.col("c_custkey") % 10 == 0, F.col("c_acctbal"))
    return O.drop_high_null(t.customer.select("c_custkey", "c_name", rare.alias("rare")), 0.8)


@query(
    "require_schema",
    "SELECT c_custkey, c_name FROM customer",
)
def require_schema(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", "c_name")
    return O.require_schema(df, ["c_custkey", "c_name"], unique="c_custkey")


# ---- parts ------------------------------------------------------------------------------------

LIST_TEXT = (
    "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '[bad' WHEN p_partkey % 5 = 0 "
    "THEN concat('[''', p_brand, ''', ''', p_type, ''']') ELSE concat('[\"', p_brand, '\", \"', p_type, '\"]') END AS list_text"
)


@query(
    "translate_values",
    "SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'BUDGET' WHEN 'STANDARD' THEN 'PLAIN' ELSE p_type END AS p_type FROM part",
)
def translate_values(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", "p_type")
    return O.translate_values(df, "p_type", {"ECONOMY": "BUDGET", "STANDARD": "PLAIN"})


NUMBER_TEXT = (
    "CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN 'Half-bath' WHEN p_partkey % 13 = 0 THEN 'medio' "
    "WHEN p_partkey % 17 = 0 THEN 'Private' WHEN p_partkey % 19 = 0 THEN '1.5 shared baths' ELSE p_brand END AS number_text"
)


@query(
    "parse_numeric",
    f"WITH p AS (SELECT p_partkey, {NUMBER_TEXT} FROM part) "
    "SELECT p_partkey, CASE WHEN regexp_matches(lower(number_text), 'half|medio') THEN 0.5 "
    "ELSE try_cast(regexp_extract(number_text, '[0-9.]+') AS DOUBLE) END AS number FROM p",
)
def parse_numeric(t: Tables) -> DataFrame:
    df = t.part.selectExpr("p_partkey", NUMBER_TEXT)
    return df.select("p_partkey", C.parse_numeric(F.col("number_text")).alias("number"))


@query(
    "keyword_flag",
    """SELECT p_partkey, CAST(regexp_matches(lower(p_name), 'red|ring') AS INT) AS flag,
    CAST(coalesce(regexp_matches(lower(CASE WHEN p_partkey % 7 <> 0 THEN p_type END), 'eco'), false) AS INT) AS flag7 FROM part""",
)
def keyword_flag(t: Tables) -> DataFrame:
    kind = F.when(F.col("p_partkey") % 7 != 0, F.col("p_type"))
    return t.part.select(
        "p_partkey",
        X.keyword_flag(F.col("p_name"), "RED|ring").alias("flag"),
        X.keyword_flag(kind, "eco").alias("flag7"),
    )


@query(
    "keyword_flag_word",
    """SELECT p_partkey, CAST(regexp_matches(lower(p_name), '\\b(red|ring)\\b') AS INT) AS flag,
    CAST(regexp_matches(lower(p_name), '\\b(re|rin)\\b') AS INT) AS part_of_word FROM part""",
)
def keyword_flag_word(t: Tables) -> DataFrame:
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        X.keyword_flag(name, "red|ring", whole_word=True).alias("flag"),
        X.keyword_flag(name, "re|rin", whole_word=True).alias("part_of_word"),
    )


@query(
    "categorize_text",
    """SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'missing' WHEN p_name LIKE '%red%' OR p_name LIKE '%blue%' THEN 'colour'
    WHEN p_name LIKE '%small%' OR p_name LIKE '%large%' THEN 'size' ELSE 'other' END AS category FROM part""",
)
def categorize_text(t: Tables) -> DataFrame:
    name = F.when(F.col("p_partkey") % 7 != 0, F.upper("p_name"))
    rules = [(("red", "blue"), "colour"), (("small", "large"), "size")]
    return t.part.select("p_partkey", X.categorize_text(name, rules, "other", "missing").alias("category"))


def _list_text() -> Column:
    key, brand, kind = F.col("p_partkey"), F.col("p_brand"), F.col("p_type")
    return (
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 11 == 0, "[bad")
        .when(key % 5 == 0, F.concat(F.lit("['"), brand, F.lit("', '"), kind, F.lit("']")))
        .otherwise(F.concat(F.lit('["'), brand, F.lit('", "'), kind, F.lit('"]')))
    )


@query(
    "parse_list",
    f"""WITH p AS (SELECT p_partkey, p_brand, p_type, {LIST_TEXT} FROM part)
    SELECT p_partkey, CASE WHEN list_text IS NULL OR list_text = '[bad' THEN '' ELSE concat(p_brand, '|', p_type) END AS items,
      CASE WHEN list_text IS NULL OR list_text = '[bad' THEN 0 ELSE 2 END AS n_items FROM p""",
)
def parse_list(t: Tables) -> DataFrame:
    items = X.parse_list(_list_text())
    return t.part.select(
        "p_partkey", F.concat_ws("|", items).alias("items"), X.list_size(items).alias("n_items")
    )


@query(
    "list_size",
    f"""WITH p AS (SELECT p_partkey, {LIST_TEXT} FROM part)
    SELECT p_partkey, CAST(CASE WHEN list_text IS NULL THEN 0 ELSE 1 + length(list_text) - length(replace(list_text, ',', '')) END AS INT) AS n_parts
    FROM p""",
)
def list_size(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.comma_count(_list_text()).alias("n_parts"))


def _printed() -> Column:
    key, kind = F.col("p_partkey"), F.col("p_type")
    second = F.when(key % 3 == 0, F.lit(", 'phone'")).otherwise(F.lit(""))
    return F.when(key % 7 == 0, "[]").otherwise(F.concat(F.lit("['"), kind, F.lit("'"), second, F.lit("]")))


KINDS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query(
    "ohe_list",
    "SELECT p_partkey, "
    + ", ".join(f"p_partkey % 7 <> 0 AND p_type = '{k}' AS tag_{k}" for k in KINDS)
    + ", p_partkey % 7 <> 0 AND p_partkey % 3 = 0 AS tag_phone FROM part",
)
def ohe_list(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", X.printed_list(_printed()).alias("tags"))
    return E.one_hot_list(df, "tags", "tag").drop("tags")


@query(
    "explode_counts",
    """SELECT token, count(*) AS n FROM (SELECT p_type AS token FROM part WHERE p_partkey % 7 <> 0
    UNION ALL SELECT 'phone' FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 3 = 0) GROUP BY token""",
)
def explode_counts(t: Tables) -> DataFrame:
    return E.token_counts(t.part.select(X.printed_list(_printed()).alias("tags")), "tags")


@query(
    "group_tokens",
    """SELECT p_brand, coalesce(bool_or(p_type = 'PROMO') FILTER (p_partkey % 7 <> 0), false) AS has_PROMO,
    coalesce(bool_or(p_partkey % 3 = 0) FILTER (p_partkey % 7 <> 0), false) AS has_phone FROM part GROUP BY p_brand""",
)
def group_tokens(t: Tables) -> DataFrame:
    df = t.part.select("p_brand", X.printed_list(_printed()).alias("tags"))
    return E.group_tokens(df, "p_brand", "tags", "has", ["PROMO", "phone"])


@query(
    "pivot_count",
    "SELECT p_brand, "
    + ", ".join(f"count(*) FILTER (p_type = '{k}') AS {k}" for k in KINDS)
    + ", count(*) FILTER (p_type IN (" + ", ".join(f"'{k}'" for k in KINDS) + ")) AS total FROM part GROUP BY p_brand",
)
def pivot_count(t: Tables) -> DataFrame:
    return A.pivot_count(t.part, "p_brand", "p_type", KINDS)


@query("rename_cols", "SELECT p_partkey, p_name AS p_brand, p_type FROM part")
def rename_cols(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return O.rename_columns(df, {"p_name": "p_brand", "absent": "other"})


@query("drop_cols", "SELECT p_partkey, p_retailprice FROM part")
def drop_cols(t: Tables) -> DataFrame:
    return O.drop_columns(t.part, ["p_name", "p_brand", "p_type", "p_size", "absent"])


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_values(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_type").distinct()
