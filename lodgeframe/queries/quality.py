"""Data-quality rules, on line items and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators import quality as Q
from lodgeframe.operators import tables as O
from lodgeframe.operators.quality import Rule
from lodgeframe.queries.registry import Tables, query, text

ITEMS = [
    "l_orderkey",
    "l_partkey",
    "l_linenumber",
    "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS quantity",
    "l_discount",
    "l_tax",
    "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_returnflag END AS flag",
    "CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS shipped",
]
WITH = f"WITH i AS (SELECT {', '.join(ITEMS)} FROM lineitem)"


def items(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(*ITEMS)


RULES = [
    Rule("unique", "order line repeated", "l_orderkey"),
    Rule("range", "line number outside 1..7", "l_linenumber", (1, 7)),
    Rule("range", "line number outside 1..7, ends allowed", "l_linenumber", (1, 7), inclusive=True),
    Rule("range", "quantity not positive", "quantity", (0, None)),
    Rule("category", "unknown flag", "flag", ["A", "R", "N"]),
    Rule("date_limit", "shipped late", "shipped", "2001-06-30"),
    Rule("not_null", "ship date missing", "shipped"),
    Rule("logic", "discount below tax", None, "l_discount >= l_tax"),
    Rule("logic", "quantity below line number", None, "quantity >= l_linenumber"),
    *Q.ranges(["l_discount", "l_tax"], 0, 0.1, "{} out of range"),
]

# Conditions that count a broken rule, written for SQL.
BROKEN = [
    ("l_orderkey", "unique", "order line repeated", None),
    ("l_linenumber", "range", "line number outside 1..7", "l_linenumber <= 1 OR l_linenumber >= 7"),
    ("l_linenumber", "range", "line number outside 1..7, ends allowed", "l_linenumber < 1 OR l_linenumber > 7"),
    ("quantity", "range", "quantity not positive", "quantity <= 0"),
    ("flag", "category", "unknown flag", "flag IS NULL OR flag NOT IN ('A', 'R', 'N')"),
    ("shipped", "date_limit", "shipped late", "shipped > DATE '2001-06-30'"),
    ("shipped", "not_null", "ship date missing", "shipped IS NULL"),
    ("logic_check", "logic", "discount below tax", "l_discount < l_tax"),
    ("logic_check", "logic", "quantity below line number", "quantity IS NULL OR quantity < l_linenumber"),
    ("l_discount", "range", "l_discount out of range", "l_discount <= 0 OR l_discount >= 0.1"),
    ("l_tax", "range", "l_tax out of range", "l_tax <= 0 OR l_tax >= 0.1"),
]


def report_sql(numbers: list[int]) -> str:
    parts = []
    for number in numbers:
        variable, kind, message, broken = BROKEN[number]
        count = f"count(*) FILTER ({broken})" if broken else f"count(*) - count(DISTINCT {variable})"
        parts.append(
            f"SELECT {number} AS rule_id, '{variable}' AS variable, '{kind}' AS check_kind, "
            f"'{message}' AS message, {count} AS n_violations FROM i"
        )
    return WITH + " " + " UNION ALL ".join(parts)


@query("dq_report", report_sql(list(range(len(BROKEN)))))
def dq_report(t: Tables) -> DataFrame:
    return Q.evaluate(items(t), RULES)


def _single(name: str, *numbers: int) -> None:
    sql = (
        f"SELECT variable, message, n_violations FROM ({report_sql(list(numbers))})"
    )

    @query(name, sql)
    def run(t: Tables) -> DataFrame:
        table = Q.evaluate(items(t), [RULES[i] for i in numbers])
        return table.select("variable", "message", "n_violations")


_single("dq_range", 1, 2, 3)
_single("dq_unique", 0)
_single("dq_category", 4)
_single("dq_logic", 7, 8)
_single("dq_date_limit", 5)
_single("dq_not_null", 6)


@query(
    "dq_dead_letter",
    f"SELECT 'validate' AS task, variable, message FROM ({report_sql(list(range(len(BROKEN))))}) WHERE n_violations > 0",
)
def dq_dead_letter(t: Tables) -> DataFrame:
    """Dead letters without their time stamp."""
    return Q.dead_letters(Q.evaluate(items(t), RULES)).drop("timestamp")


ROW_RULES = [i for i, (_, kind, _, _) in enumerate(BROKEN) if kind != "unique"]


@query(
    "dq_broken_rules",
    WITH
    + ", f AS (SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('|', "
    + ", ".join(f"CASE WHEN {BROKEN[i][3]} THEN '{BROKEN[i][2]}' END" for i in ROW_RULES)
    + ") AS failures FROM i) SELECT * FROM f WHERE failures <> ''",
)
def dq_broken_rules(t: Tables) -> DataFrame:
    table = Q.broken_rules(items(t), RULES, ["l_orderkey", "l_linenumber", "l_partkey"])
    return table.withColumn("failures", F.concat_ws("|", "failures"))


def masks() -> dict:
    c = F.col
    return {
        "size": (c("l_linenumber") >= 1) & (c("quantity") >= 2),
        "rates": c("l_discount").between(0.01, 0.09) & c("l_tax").between(0, 0.07),
        "dates": O.optional(c("shipped") <= F.lit("2001-06-30").cast("date"), c("shipped")),
    }


MASK_SQL = {
    "size": "coalesce(l_linenumber >= 1 AND quantity >= 2, false)",
    "rates": "l_discount BETWEEN 0.01 AND 0.09 AND l_tax BETWEEN 0 AND 0.07",
    "dates": "(shipped IS NULL OR shipped <= DATE '2001-06-30')",
}


@query(
    "dq_row_failures",
    WITH
    + ", f AS (SELECT l_orderkey, l_linenumber, l_partkey, concat_ws('|', "
    + ", ".join(f"CASE WHEN NOT ({m}) THEN '{n}' END" for n, m in MASK_SQL.items())
    + ") AS failures FROM i) SELECT * FROM f WHERE failures <> ''",
)
def dq_row_failures(t: Tables) -> DataFrame:
    table = O.row_failures(items(t), masks(), ["l_orderkey", "l_linenumber", "l_partkey"])
    return table.withColumn("failures", F.concat_ws("|", "failures"))


@query(
    "filter_valid",
    WITH
    + ", v AS (SELECT * FROM i WHERE "
    + " AND ".join(MASK_SQL.values())
    + """ AND flag IS NOT NULL)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(shipped AS VARCHAR) AS shipped FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, quantity, coalesce(shipped, DATE '1900-01-01')) AS r FROM v)
    WHERE r = 1""",
)
def filter_valid(t: Tables) -> DataFrame:
    """Valid rows with a key, one per order."""
    kept = items(t).transform(O.filter_valid, masks()).transform(O.drop_null_rows, ["flag"])
    first = O.dedup_key(kept, ["l_orderkey"], ["l_linenumber", "l_partkey", "quantity", "shipped"])
    return first.select("l_orderkey", "l_linenumber", "l_partkey", text("shipped").alias("shipped"))
