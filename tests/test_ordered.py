from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import distributions as D
from lodgeframe.operators import ordered as O
from lodgeframe.operators import windows as W
from tests.helpers import rows


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small data would be merged into one slice, which would leave the carrying over untested."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def history() -> pd.DataFrame:
    """One entity holds most rows, and many of its rows share one time."""
    rng = np.random.default_rng(3)
    n = 6_000
    return pd.DataFrame(
        {
            "id": range(n),
            "entity": np.where(rng.random(n) < 0.7, "hot", rng.integers(0, 50, n).astype(str)),
            "ts": np.where(rng.random(n) < 0.4, 100, rng.integers(0, 1000, n)),
            "v": rng.integers(0, 3, n),
        }
    )


def test_previous_row_across_slices(spark):
    frame = history()
    got = W.change_flags(spark.createDataFrame(frame), "entity", ["ts", "id"], ["v"])
    got = dict(rows(got.select("id", "v_changed")))
    ordered = frame.sort_values(["entity", "ts", "id"])
    want = ordered.groupby("entity")["v"].diff().ne(0)
    assert got == dict(zip(ordered["id"], want))


def test_hot_entity_spans_slices(spark):
    df = O.sliced(spark.createDataFrame(history()), ["entity", "ts", "id"])
    counts = [r["count"] for r in df.groupBy(O.SLICE).count().collect()]
    assert len(counts) > 3 and max(counts) < 0.5 * sum(counts)


def test_missing_values_count_as_changed(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("a", 3, None), ("a", 4, 5), ("a", 5, 5)], "e string, t int, v int")
    got = W.change_flags(df, "e", ["t"], ["v"])
    assert rows(got.select("t", "v_changed"), "t") == [(1, True), (2, True), (3, True), (4, True), (5, False)]


def test_running_sum(spark):
    df = spark.range(5_000).select(F.col("id").alias("x"), (F.col("id") % 7).alias("w"))
    got = rows(O.with_running_sum(df, ["x"], "w", "s").select("x", "s"), "x")
    assert [s for _, s in got] == np.cumsum(np.arange(5_000) % 7).tolist()


def test_ecdf(spark):
    data = np.random.default_rng(1).normal(size=3_000).round(2)
    got = rows(D.ecdf(spark.createDataFrame(pd.DataFrame({"v": data})), "v").select("v", "ecdf"), "v")
    values, counts = np.unique(data, return_counts=True)
    np.testing.assert_allclose([v for v, _ in got], values)
    np.testing.assert_allclose([e for _, e in got], np.cumsum(counts) / len(data))


def test_centred_means_match_pandas(spark):
    frame = pd.DataFrame({"d": range(40), "v": np.random.default_rng(2).random(40)})
    got = W.centred_means(spark.createDataFrame(frame), "d", "v", {"m7": 7, "m30": 30}).orderBy("d").toPandas()
    for name, size in (("m7", 7), ("m30", 30)):
        np.testing.assert_allclose(got[name], frame["v"].rolling(size, center=True).mean(), rtol=1e-12)
    assert got["m30"].notna().to_numpy().nonzero()[0].tolist() == list(range(15, 26))


def test_monthly_changes(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("a", "2024-01-09", 2), ("a", "2024-02-01", 2), ("b", "2024-01-03", 1)], "e string, d string, v int")
    got = W.monthly_changes(df.withColumn("d", F.to_date("d")), "e", "d", "v")
    assert [(str(m), n) for m, n in rows(got, "month")] == [("2024-01-01", 1), ("2024-02-01", 0)]
