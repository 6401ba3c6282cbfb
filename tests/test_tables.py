from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lodgeframe.operators import encode as E
from lodgeframe.operators import lookups as L
from lodgeframe.operators import tables as O
from lodgeframe.operators.sizing import SALT, attach_by_key, spread_join
from lodgeframe.functions.text import printed_list
from tests.helpers import plan, rows


def test_override_by_id_list_table_and_long_list(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, 3.0)], "id bigint, v double")
    want = [(1, 9.0), (2, 2.0), (None, 3.0)]
    ids = spark.createDataFrame([(1,), (1,)], "id bigint")
    for chosen in ([1], ids, list(range(-2_000, 2))):
        got = rows(O.override_by_id(df, "id", chosen, "v", 9.0), F.col("id").asc_nulls_last())
        assert got == want


def test_override_if_all_null(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 7.0)], "id int, v double")
    assert rows(O.override_if_all_null(df, "id", {1: 5.0, 2: 6.0}, "v"), "id") == [(1, 5.0), (2, 6.0), (3, 7.0)]
    assert rows(O.override_if_all_null(df, "id", {1: 5.0, 3: 6.0}, "v"), "id") == [(1, None), (2, None), (3, 7.0)]


def test_reconcile(spark):
    few = spark.createDataFrame([(1.0, 1.0)] * 19 + [(1.0, 2.0)], "a double, b double")
    assert {r[2] for r in rows(O.reconcile_columns(few, "a", "b", "c"))} == {1.0, 2.0}
    many = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert rows(O.reconcile_columns(many, "a", "b", "c").select("c"), "c") == [(1.0,), (3.0,)]


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert O.drop_columns(df, ["b", "zz"]).columns == ["a", "c"]
    assert O.rename_columns(df, {"a": "c", "zz": "y"}).columns == ["c", "b"]
    assert rows(O.rename_columns(df, {"a": "c"})) == [(1, None)]
    assert O.drop_high_null(df, 0.8).columns == ["a", "c"]
    assert O.log1p_columns(df, ["a", "zz"]).columns == ["a", "b", "c", "a_log"]
    assert rows(O.translate_values(df, "c", {"x": "y"}).select("c")) == [("y",)]
    assert O.translate_values(df, "zz", {"x": "y"}) is df


def test_drop_null_rows_reports_counts(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, v string")
    counts = Observation()
    assert rows(O.drop_null_rows(df, ["k", "v"], counts)) == [(1, "a")]
    assert counts.get == {"rows_in": 3, "rows_kept": 1}


def test_filter_valid_counts_failures(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (5, None)], "a int, b int")
    counts = Observation()
    masks = {"a": F.col("a") > 0, "b": O.optional(F.col("b") == 1, F.col("b"))}
    assert sorted(rows(O.filter_valid(df, masks, counts))) == [(1, 1), (5, None)]
    assert counts.get == {"rows_in": 3, "failed_a": 1, "failed_b": 0}
    assert rows(O.row_failures(df, masks, ["b"])) == [(1, ["a"])]


def test_require_schema(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(ValueError, match="missing columns"):
        O.require_schema(df, ["id", "x"])
    with pytest.raises(Exception, match="id repeated: 1"):
        rows(O.require_schema(df, ["id"], unique="id"))
    assert rows(O.require_schema(df.distinct(), ["id"], unique="id")) == [(1,)]


def test_dedup(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (1, "a", 1), (2, None, None)], "k int, v string, o int")
    assert rows(O.dedup_exact(df), "k", "v") == [(1, "a", 1), (1, "b", 2), (2, None, None)]
    assert rows(O.dedup_key(df, ["k"], ["o"]), "k") == [(1, "a", 1), (2, None, None)]
    assert rows(O.duplicate_count(df)) == [(4, 3, 1)]


def test_trim_quantile(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert O.trim_quantile(df, "v", 0.9).count() == 90


def test_lookups(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "k int, name string")
    assert rows(L.lookup_join(df, dim, "k"), F.col("k").asc_nulls_last()) == [(1, "one"), (2, None), (None, None)]
    facts = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    got = rows(L.agg_join_back(df, facts, "k", {"n": F.count(F.lit(1))}), F.col("k").asc_nulls_last())
    assert got == [(1, 2), (2, 0), (None, 0)]
    assert rows(L.semi_join(df, facts, "k")) == [(1,)]
    assert rows(L.set_difference(df, dim.select("k")), F.col("k").asc_nulls_last()) == [(2,), (None,)]
    left = spark.createDataFrame([(" a",), ("b ",)], "k string")
    right = spark.createDataFrame([("b",), ("c",)], "k string")
    assert rows(L.key_differences(left, right, "k", ("l", "r")), "k") == [("a", "l"), ("c", "r")]


def test_event_windows_overlap(spark):
    years = spark.createDataFrame([(2026,)], "year int")
    windows = L.event_windows(years)
    got = {r["label"]: (str(r["start"]), str(r["end"])) for r in windows.collect()}
    assert got["Semana Santa"] == ("2026-03-27", "2026-04-04") and got["Navidad"] == ("2026-12-20", "2027-01-06")
    days = spark.createDataFrame([("2026-12-20",), ("2026-12-07",), ("2026-02-01",)], "d string").select(F.to_date("d").alias("d"))
    extra = spark.createDataFrame([("Own", "2026-12-19", "2026-12-21")], "label string, start string, end string")
    extra = extra.select("label", F.to_date("start").alias("start"), F.to_date("end").alias("end"))
    joined = L.interval_join(days, "d", windows.unionByName(extra))
    assert [(str(d), e) for d, e in rows(joined, "d", "event")] == [
        ("2026-12-07", "Puente de diciembre"), ("2026-12-20", "Navidad"), ("2026-12-20", "Own"),
    ]


def test_joins_carry_no_hint_and_hot_keys_are_dealt(spark):
    large = spark.range(1_000).select((F.col("id") % 3).alias("k"), "id")
    table = large.groupBy("k").agg(F.count("*").alias("n"))
    assert "strategy=broadcast" not in plan(attach_by_key(large, table, ["k"]))
    spread = spread_join(large, table, ["k"], ["id"], salts=8)
    assert spread.count() == 1_000
    assert spread.where("k = 0").select(SALT).distinct().count() == 8


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "['email', 'phone']"), (2, "[]"), (3, None), (4, "['phone', 'phone']")], "id int, t string")
    df = df.select("id", printed_list(F.col("t")).alias("tags"))
    got = E.one_hot_list(df, "tags", "v")
    assert got.columns == ["id", "tags", "v_email", "v_phone"]
    assert rows(got.drop("tags"), "id") == [(1, True, True), (2, False, False), (3, False, False), (4, False, True)]
    assert rows(E.token_counts(df, "tags"), "token") == [("email", 1), ("phone", 2)]
    assert rows(E.group_tokens(df.withColumn("g", F.lit(1)), "g", "tags", "v", ["phone"])) == [(1, True)]
    many = spark.range(450).select(F.array(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("tags"))
    assert len(E.one_hot_list(many, "tags", "v").columns) == 451
    kinds = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(E.one_hot(kinds, "k"), "k_a") == [(None, False), ("a", True)]
