"""Data-quality rules: evaluated together, reported per rule, never changing the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions.clean import is_true

CHECKS = ("range", "unique", "category", "logic", "date_limit", "not_null")


@dataclass(frozen=True)
class Rule:
    """One check on a column, or on a row predicate for ``logic``.

    ``params``: (lo, hi) for range, values for category, a Column or SQL text for logic, a date for
    date_limit.
    Ranges are open intervals unless ``inclusive``. Missing values pass range and date_limit and
    fail category and logic.
    """

    check: str
    message: str
    column: str | None = None
    params: Any = None
    inclusive: bool = False

    def __post_init__(self) -> None:
        if self.check not in CHECKS:
            raise ValueError(f"unknown check {self.check!r}")

    @property
    def variable(self) -> str:
        return self.column or "logic_check"

    def violation(self) -> Column:
        """True on rows that break the rule (not defined for unique)."""
        c = F.col(self.column) if self.column else None
        if self.check == "range":
            lo, hi = self.params
            bad = F.lit(False)
            if lo is not None:
                bad = bad | (c < F.lit(lo) if self.inclusive else c <= F.lit(lo))
            if hi is not None:
                bad = bad | (c > F.lit(hi) if self.inclusive else c >= F.lit(hi))
            return is_true(bad)
        if self.check == "category":
            return ~is_true(c.isin(*self.params))
        if self.check == "logic":
            holds = F.expr(self.params) if isinstance(self.params, str) else self.params
            return ~is_true(holds)
        if self.check == "date_limit":
            return is_true(c.cast("date") > F.lit(self.params).cast("date"))
        if self.check == "not_null":
            return c.isNull()
        raise ValueError("unique is a property of the table")


def ranges(columns: Sequence[str], lo: float | None, hi: float | None, message: str) -> list[Rule]:
    """The same range rule for several columns; ``{}`` in the message is the column."""
    return [Rule("range", message.format(c), c, (lo, hi)) for c in columns]


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule_id, variable, check_kind, message, n_violations), one row per rule.

    All row rules share one aggregate over one scan, all unique rules another. Uniqueness counts rows
    per key first, so a key that fills a third of the table is already one number per task when it is shuffled.
    """
    cells, keys, heads, tables = [], [], {}, []
    for i, rule in enumerate(rules):
        head = [
            F.lit(i).alias("rule_id"),
            F.lit(rule.variable).alias("variable"),
            F.lit(rule.check).alias("check_kind"),
            F.lit(rule.message).alias("message"),
        ]
        if rule.check == "unique":
            keys.append(F.struct(F.lit(i).alias("_rule"), F.col(rule.column).cast("string").alias("_key")))
            heads[i] = head
        else:
            cells.append(F.struct(*head, F.count_if(rule.violation()).alias("n_violations")))
    if cells:
        tables.insert(0, df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")))
    if keys:
        counted = df.select(F.inline(F.array(*keys))).groupBy("_rule", "_key").agg((F.count(F.lit(1)) - 1).alias("_s"))
        sums = [F.coalesce(F.sum(F.when(F.col("_rule") == i, F.col("_s"))), F.lit(0)).alias(f"_n{i}") for i in heads]
        rows = F.array(*[F.struct(*head, F.col(f"_n{i}").alias("n_violations")) for i, head in heads.items()])
        tables.append(counted.agg(*sums).select(F.inline(rows)))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def dead_letters(report: DataFrame, task: str = "validate", at: Column | None = None) -> DataFrame:
    """One record per failed rule."""
    stamp = F.current_timestamp() if at is None else at
    return report.where("n_violations > 0").select(
        F.lit(task).alias("task"),
        "variable",
        "message",
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
    )


def broken_rules(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """Rows that break a row rule, with the messages."""
    messages = F.array_compact(
        F.array(*[F.when(r.violation(), F.lit(r.message)) for r in rules if r.check != "unique"])
    )
    return df.select(*keep, messages.alias("failures")).where(F.size("failures") > 0)
