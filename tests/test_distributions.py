from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import aggregates as A
from lodgeframe.operators import distributions as D
from tests.helpers import rows


def frame(spark, data, column="v"):
    return spark.createDataFrame(pd.DataFrame({column: data}))


@pytest.mark.parametrize("data, kwargs", [
    ([0.0, 0.1, 0.2, 0.3, 0.7, 1.0], {}),
    ([1.0, 2.0, 2.5, 3.0, 9.0, 10.0, -1.0, 99.0], {"lo": 1.0, "hi": 10.0}),
    ([5.0, 5.0], {}),
    (list(np.random.default_rng(4).exponential(100, 2_000).round(2)), {}),
])
def test_histogram_matches_numpy(spark, data, kwargs):
    span = (kwargs["lo"], kwargs["hi"]) if kwargs else None
    want, edges = np.histogram(data, bins=10, range=span)
    got = D.histogram(frame(spark, data), "v", 10, **kwargs).orderBy("bin").toPandas()
    assert got["n"].tolist() == want.tolist()
    np.testing.assert_allclose(got["left"], edges[:-1])
    np.testing.assert_allclose(got["right"], edges[1:])


def test_histogram_clip_and_empty(spark):
    got = D.histogram(frame(spark, [0.0, 4.0, 600.0]), "v", 5, clip_upper=500).orderBy("bin").toPandas()
    assert got["n"].tolist() == [2, 0, 0, 0, 1] and got["right"].iloc[-1] == 500
    empty = spark.createDataFrame([], "v double")
    assert D.histogram(empty, "v", 3).agg(F.sum("n")).first()[0] == 0


def test_cut_equal_matches_pandas(spark):
    data = np.random.default_rng(5).uniform(0, 20, 500).round(1)
    want = pd.cut(pd.Series(data), bins=10, labels=False)
    got = D.cut_equal(frame(spark, data), "v", 10).groupBy("v").agg(F.max("bin").alias("b")).toPandas()
    lookup = dict(zip(got["v"], got["b"]))
    assert [lookup[v] for v in data] == want.tolist()


def test_cut_equal_median_lists_empty_bins(spark):
    df = spark.createDataFrame([(0.0, 10.0), (1.0, 20.0), (10.0, 30.0)], "d double, p double")
    got = D.cut_equal_median(df, "d", "p", 5).orderBy("bin").toPandas()
    assert got["median"].tolist() == [15.0, 0.0, 0.0, 0.0, 30.0] and got["n"].tolist() == [2, 0, 0, 0, 1]


def test_cut_edges(spark):
    df = frame(spark, [0.0, 1.0, 1.5, 3.0, 4.0])
    labels = rows(df.select("v", D.cut_edges(F.col("v"), [0, 1, 3], ["a", "b"]).alias("l")), "v")
    assert labels == [(0.0, None), (1.0, "a"), (1.5, "b"), (3.0, "b"), (4.0, None)]


def test_qcut_keeps_ties_together(spark):
    data = [1.0] * 6 + [2.0, 3.0, 4.0, 5.0, 6.0]
    want = pd.qcut(pd.Series(data), 4, labels=False, duplicates="drop")
    got = D.qcut(frame(spark, data), "v", ["a", "b", "c", "d"]).toPandas()
    assert got.groupby("v")["segment"].nunique().max() == 1
    assert got[got["v"] == 1.0]["segment"].unique().tolist() == ["a"] and len(want) == len(got)


def test_describe_matches_pandas(spark):
    data = pd.Series(np.random.default_rng(6).normal(size=333))
    want = data.describe()
    got = D.describe(frame(spark, data), "v").toPandas().iloc[0]
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "p25": "25%", "p50": "50%", "p75": "75%", "max": "max"}
    for ours, theirs in names.items():
        assert got[ours] == pytest.approx(want[theirs])


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]] + [("b", 7.0)], "k string, v double")
    got = D.box_stats(df, "v", "k").orderBy("k").toPandas().to_dict("records")
    assert got[0]["whisker_high"] == 4.0 and got[0]["n_outliers"] == 1 and got[0]["q2"] == 3.0
    assert got[1]["whisker_low"] == got[1]["whisker_high"] == 7.0 and got[1]["n_outliers"] == 0


def test_corr_matches_pandas_and_survives_constants(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": rng.normal(size=200), "b": rng.normal(size=200), "c": 1.0})
    pdf["b"] += pdf["a"]
    pdf.loc[::5, "a"] = None
    df = spark.createDataFrame(pdf).withColumn("a", F.nanvl("a", F.lit(None).cast("double")))
    got = {(r[0], r[1]): r[2] for r in rows(A.corr_matrix(df, ["a", "b", "c"], None))}
    want = pdf.corr()
    for (x, y), value in got.items():
        if "c" in (x, y):
            assert value is None
        else:
            assert value == pytest.approx(want.loc[x, y])


def test_t_test_and_p_values(spark):
    df = spark.createDataFrame([(True, 1.0), (True, 2.0), (True, 3.0), (False, 2.0), (False, 4.0), (False, 6.0), (False, 8.0)], "g boolean, v double")
    row = A.two_sample_t(df, F.col("g"), F.col("v")).first()
    assert row["df"] == 5 and row["t"] == pytest.approx(-1.8, abs=0.1)
    # Published two-sided points of the t distribution.
    table = [(12.706, 1, 0.05), (2.571, 5, 0.05), (2.228, 10, 0.05), (4.587, 10, 0.001), (1.96, 1_000_000, 0.05), (0.0, 4, 1.0)]
    data = spark.createDataFrame([(t, float(n), p) for t, n, p in table], "t double, n double, p double")
    for p, want in data.select(A.two_sided_p(F.col("t"), F.col("n")), "p").collect():
        assert p == pytest.approx(want, rel=2e-3)


def test_zscore_uses_population_deviation(spark):
    data = [0.0] * 99 + [10.0]
    got = rows(D.zscore_outliers(frame(spark, data), "v").select("v", "z"))
    assert len(got) == 1 and got[0][1] == pytest.approx((10 - 0.1) / np.std(data))
    assert rows(D.zscore_outliers(frame(spark, [1.0, 1.0]), "v")) == []


def test_outlier_flags_total(spark):
    df = frame(spark, [1.0, 5.0, 9.0])
    got = D.outlier_flags(df, {"big": F.col("v") > 4, "huge": F.col("v") > 8, "unknown": F.lit(None).cast("boolean")})
    assert rows(got.select("v", "total_flags"), "v") == [(1.0, 0), (5.0, 1), (9.0, 2)]


def test_value_counts_and_peak(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "k string")
    assert rows(A.value_counts(df, "k")) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(A.value_counts(df, "k", nulls=True)) == [("a", 2), ("b", 2), ("c", 1), (None, 1)]
    assert rows(A.value_counts(df, "k", top=1, share=True)) == [("a", 2, 0.4)]
    peaks = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.9)], "d int, v double")
    assert rows(A.peak_key(peaks, "d", "v")) == [(2, 0.9)]


def test_pivots(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), ("y", "q", 4), ("y", "q", 6)], "r string, c string, v int")
    assert rows(A.pivot_count(df, "r", "c", ["p", "q"])) == [("x", 1, 1, 2), ("y", 0, 2, 2)]
    assert rows(A.pivot_mean(df, "r", "c", ["p", "q"], F.col("v")), "r") == [("x", 1.0, 2.0), ("y", None, 5.0)]


def test_group_median_topn(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 9.0), ("c", None)], "k string, v double")
    assert rows(A.group_median_topn(df, "k", "v", 2)) == [("b", 9.0, 9.0, 9.0, 9.0), ("a", 1.5, 1.5, 1.0, 2.0)]


def test_coverage_anomalies(spark):
    sizes = {1: 10, 2: 10, 3: 4, 4: 3}
    df = spark.createDataFrame([(d, i % n) for d, n in sizes.items() for i in range(20)], "d int, id int")
    # The median day has 7 ids, so days below 3.5 are reported.
    assert rows(A.coverage_anomalies(df, "d", "id").select("d", "n", "expected")) == [(4, 3, 7.0)]


def test_null_profile_and_words(spark):
    df = spark.createDataFrame([(None, "the good good"), (None, "bad Good!"), (1, None)], "a int, t string")
    assert rows(A.null_profile(df)) == [("a", 66.67), ("t", 33.33)]
    assert rows(A.null_profile(df, over=50.0)) == [("a", 66.67)]
    assert rows(A.word_freq(df, "t")) == [("good", 3), ("bad", 1)]
