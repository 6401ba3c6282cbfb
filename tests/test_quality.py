from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import quality as Q
from lodgeframe.operators.quality import Rule
from tests.helpers import plan, rows


def violations(df, rule) -> int:
    return Q.evaluate(df, [rule]).first()["n_violations"]


def test_range_is_open_unless_inclusive(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (10,), (11,), (None,)], "v int")
    assert violations(df, Rule("range", "m", "v", (1, 10))) == 4
    assert violations(df, Rule("range", "m", "v", (1, 10), inclusive=True)) == 2
    assert violations(df, Rule("range", "m", "v", (None, 10))) == 2
    assert violations(df, Rule("range", "m", "v", (1, None))) == 2


def test_missing_values_per_check(spark):
    df = spark.createDataFrame([(1, "2024-01-01", "a"), (None, None, None)], "v int, d string, k string")
    assert violations(df, Rule("category", "m", "k", ["a"])) == 1
    assert violations(df, Rule("logic", "m", None, F.col("v") >= 1)) == 1
    assert violations(df, Rule("logic", "m", None, "v >= 1")) == 1
    assert violations(df, Rule("date_limit", "m", "d", "2023-12-31")) == 1
    assert violations(df, Rule("date_limit", "m", "d", "2024-01-01")) == 0
    assert violations(df, Rule("not_null", "m", "d")) == 1


def test_unique_counts_two_nulls_as_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "v int")
    assert violations(df, Rule("unique", "m", "v")) == 3
    assert violations(df.limit(0), Rule("unique", "m", "v")) == 0


def test_unknown_check():
    with pytest.raises(ValueError, match="unknown check"):
        Rule("near", "m", "v")


def test_dead_letters(spark):
    df = spark.createDataFrame([(1,), (99,)], "v int")
    rules = [Rule("range", "too big", "v", (None, 50)), Rule("range", "fine", "v", (0, None)), Rule("logic", "odd", None, "v < 0")]
    letters = Q.dead_letters(Q.evaluate(df, rules), at=F.lit("2025-01-02 03:04:05").cast("timestamp"))
    got = [json.loads(r[0]) for r in letters.select(F.to_json(F.struct("*"))).collect()]
    assert got == [
        {"task": "validate", "variable": "v", "message": "too big", "timestamp": "2025-01-02T03:04:05.000000"},
        {"task": "validate", "variable": "logic_check", "message": "odd", "timestamp": "2025-01-02T03:04:05.000000"},
    ]


def test_row_rules_share_one_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [*Q.ranges(["id"] * 5, 0, 5, "{}"), Rule("not_null", "m", "id")]
    physical = plan(Q.evaluate(df, rules)).split("== Physical Plan ==")[1]
    assert physical.count("FileScan") == 1


def test_broken_rules_names_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, v int")
    got = Q.broken_rules(df, [Rule("not_null", "missing", "v"), Rule("range", "low", "v", (7, None)), Rule("unique", "u", "id")], ["id"])
    assert rows(got, "id") == [(1, ["low"]), (2, ["missing"])]
