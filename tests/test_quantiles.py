from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgeframe.operators import quantiles as Q
from lodgeframe.operators import selection as S
from tests.helpers import plan, rows

WANTED = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q95": 0.95, "q100": 1.0}


def expected(frame: pd.DataFrame) -> dict:
    return {
        k: np.quantile(g["v"].dropna(), list(WANTED.values())) if g["v"].notna().any() else None
        for k, g in frame.groupby("k")
    }


def skewed_frame() -> pd.DataFrame:
    rng = np.random.default_rng(7)
    hot = pd.DataFrame({"k": "hot", "v": np.exp(rng.normal(size=150_000))})
    ties = pd.DataFrame({"k": "ties", "v": rng.integers(0, 3, 130_000).astype(float)})
    small = pd.DataFrame({"k": [f"s{i % 40}" for i in range(400)], "v": rng.normal(size=400)})
    odd = pd.DataFrame({"k": ["one", "none", "none", None], "v": [5.0, None, np.nan, 1.0]})
    return pd.concat([hot, ties, small, odd], ignore_index=True)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The frame, and the same rows in Spark with missing values both as null and as NaN."""
    frame, path = skewed_frame(), str(tmp_path_factory.mktemp("skewed") / "rows.parquet")
    frame.to_parquet(path, index=False)
    extra = spark.createDataFrame([("none", float("nan"))], "k string, v double")
    return frame, spark.read.parquet(path).union(extra)


def test_groups_match_numpy_with_a_hot_group(skewed):
    frame, df = skewed
    table = Q.exact_quantiles(df.repartition(7), "v", WANTED, ["k"])
    got, want = {r[0]: r[1:] for r in rows(table)}, expected(frame)
    assert set(got) == set(want)
    for key, numbers in want.items():
        if numbers is None:
            assert got[key] == (None,) * len(WANTED)
        else:
            np.testing.assert_allclose(got[key], numbers, rtol=1e-12)


def test_global_and_extras(skewed):
    frame, df = skewed
    table = Q.exact_quantiles(df, "v", WANTED, extras={"n": F.count(F.lit(1))})
    (row,) = rows(table)
    np.testing.assert_allclose(row[:-1], np.quantile(frame["v"].dropna(), list(WANTED.values())), rtol=1e-12)
    assert row[-1] == len(frame) + 1


def test_no_values_give_null(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert rows(Q.exact_quantiles(df, "v", {"m": 0.5})) == [(None,)]
    assert rows(Q.exact_quantiles(df, "v", {"m": 0.5}, ["k"])) == [("a", None)]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6)), min_size=1, max_size=30), st.floats(0, 1))
def test_any_quantile(spark, data, q):
    df = spark.createDataFrame(data, "k string, v double")
    frame = pd.DataFrame(data, columns=["k", "v"])
    want = {k: np.quantile(g["v"], q) for k, g in frame.groupby("k")}
    got = dict(rows(Q.exact_quantiles(df, "v", {"x": q}, ["k"])))
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_group_medians_share_one_pass(spark):
    df = spark.createDataFrame([("a", 1.0, 9.0), ("a", 3.0, None), ("b", None, 4.0), (None, 7.0, 7.0)], "k string, x double, y double")
    table = Q.group_medians(df, {"mx": "x", "my": "y"}, ["k"], {"n": F.count(F.lit(1))})
    assert rows(table.select("k", "mx", "my", "n"), "k") == [("a", 2.0, 9.0, 2), ("b", None, 4.0, 1)]


def test_mode_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (3, "z")], "k int, v string")
    assert rows(Q.group_mode(df, "v", ["k"]), "k") == [(1, "a"), (3, "z")]
    assert rows(Q.group_mode(df, "v")) == [("a",)]


def test_slices_that_cut_groups(spark):
    """Many slices: groups inside one, over two and over many of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = np.random.default_rng(3)
        frame = pd.DataFrame({"k": rng.choice(["a", "b", "c", "d"], 6000, p=[0.9, 0.05, 0.04, 0.01]), "v": rng.normal(size=6000)})
        got = {r[0]: r[1:] for r in rows(Q.exact_quantiles(spark.createDataFrame(frame).repartition(11), "v", WANTED, ["k"]))}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for key, numbers in expected(frame).items():
        np.testing.assert_allclose(got[key], numbers, rtol=1e-12)


@pytest.mark.parametrize(
    "values",
    [
        [1.7e9 + i * 1e-6 for i in range(5000)],  # all in one bin of the first round
        [2.0**k for k in range(-1074, 1024)] + [-(2.0**k) for k in range(-1074, 1024)],
        [np.nextafter(2.0**k, side) for k in range(-60, 60) for side in (0.0, np.inf)],
        [-np.inf, np.inf, -1.7976931348623157e308, 1.7976931348623157e308, 0.0, -0.0, 5e-324],
        [0.1] * 4000 + [0.2] * 3 + [-0.1] * 4000,
    ],
)
def test_ranks_of_any_range(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "_v double").repartition(5)
    ranks = sorted({0, len(values) // 3, len(values) // 2, len(values) - 1})
    found = S.select_ranks(df, [], [str(r) for r in ranks]).collect()
    ordered = sorted(values)
    assert sorted({r["_v"] for r in found}) == sorted({ordered[r] for r in ranks})
    assert all(r["_n"] == len(values) and r["_seen"] == sum(v <= r["_v"] for v in values) for r in found)


def test_bins_never_fall(spark):
    rng = np.random.default_rng(1)
    values = np.sort(np.concatenate([np.exp(rng.normal(size=4000) * 40) * rng.choice([-1, 1], 4000), 2.0 ** np.arange(-80, 80)]))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").coalesce(1)
    bins = [r.b for r in df.select("v", S.octave_bin("v").alias("b")).orderBy("v").collect()]
    assert bins == sorted(bins) and len(set(bins)) > 3000


def test_nothing_runs_while_the_frame_is_built(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("v"))
    spark.sparkContext.setJobGroup("build", "quantiles")
    Q.exact_quantiles(df, "v", WANTED, ["k"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_a_hot_group_is_not_one_task(spark):
    """The values of a group are never brought together: windows run over bins and what is left of them."""
    df = spark.range(200_000).select(F.lit("hot").alias("k"), F.sqrt("id").alias("v"))
    table = Q.exact_quantiles(df, "v", {"m": 0.5}, ["k"])
    assert rows(table) == [("hot", pytest.approx(np.median(np.sqrt(np.arange(200_000))), rel=1e-12))]
    assert "RangePartitioning" not in plan(table)


def test_counted_statistics_of_many_groupings(spark):
    nan = float("nan")
    rows = [(i, i % 3 if i % 5 else None, "ab"[i % 2], [1.5 * (i % 7), None, nan][0 if i % 4 else i % 3], float(i) if i != 9 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, size int, `kind` string, x double, y double")
    cells = Q.count_values(df, {"x": ["size"], "y": ["size", "kind"]})
    got = {(r["_column"], r["size"], r["kind"]): (r["_median"], r["_spread"]) for r in Q.counted_statistics(cells).collect()}
    frame = df.toPandas()
    want = {}
    for size, part in frame.groupby("size", dropna=False):
        size = None if size != size else int(size)
        want["x", size, None] = (part.x.median(), part.x.std())
        for kind, piece in part.groupby("kind"):
            want["y", size, kind] = (piece.y.median(), piece.y.std())
    assert got.keys() == want.keys()
    for key, (median, spread) in want.items():
        assert got[key][0] == median and abs(got[key][1] - spread) < 1e-9
    single = spark.createDataFrame([(1, "a", 4.0), (2, "a", None)], "size int, kind string, x double")
    only = Q.counted_statistics(Q.count_values(single, {"x": ["size"]})).collect()
    assert [(r["size"], r["_median"], r["_spread"]) for r in only] == [(1, 4.0, None)]
    assert Q.counted_statistics(Q.count_values(single.limit(0), {"x": ["size"]})).collect() == []


def test_counted_statistics_count_in_one_scan(spark):
    df = spark.range(50).selectExpr("id % 4 AS a", "id % 3 AS b", "CAST(id AS DOUBLE) AS x", "CAST(id * 2 AS DOUBLE) AS y")
    plan = Q.count_values(df, {"x": ["a"], "y": ["b"]})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Aggregate") == 1
