from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodgeframe.operators import impute as I
from tests.helpers import rows

DATA = [
    (1, "even", 1.0), (2, "even", 3.0), (3, "even", None), (4, "odd", 5.0), (5, "odd", None),
    (6, "none", None), (7, None, 8.0), (8, None, None),
]
DDL = "id int, g string, v double"


def test_median(spark):
    df = spark.createDataFrame(DATA, DDL)
    assert rows(I.impute_median(df, "v", "g").select("id", "v"), "id") == [
        (1, 1.0), (2, 3.0), (3, 2.0), (4, 5.0), (5, 5.0), (6, None), (7, 8.0), (8, None),
    ]


def test_global_fallback_uses_the_filled_column(spark):
    df = spark.createDataFrame(DATA, DDL)
    got = dict(rows(I.impute_median(df, "v", "g", global_fallback=True).select("id", "v")))
    assert got[6] == got[8] == np.median([1, 3, 2, 5, 5, 8])


def test_mode(spark):
    df = spark.createDataFrame([(1, "g", "b"), (2, "g", "a"), (3, "g", "b"), (4, "g", "a"), (5, "g", None), (6, None, None)], "id int, g string, v string")
    got = dict(rows(I.impute_mode(df, "v", "g").select("id", "v")))
    assert got[5] == "a" and got[6] is None


def noisy(spark, n=20_000):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"id": range(n), "g": rng.integers(0, 3, n), "v": rng.normal(50, 10, n)})
    frame.loc[frame["id"] % 4 == 0, "v"] = None
    return frame, spark.createDataFrame(frame).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))


def test_noise_properties(spark):
    frame, df = noisy(spark)
    out = I.impute_median(df, "v", "g", I.Noise("id")).orderBy("id").toPandas()
    again = I.impute_median(df.repartition(13), "v", "g", I.Noise("id")).orderBy("id").toPandas()
    assert out["v"].notna().all()
    # The draws are the same; the group deviation is a sum whose order may differ in the last bit.
    np.testing.assert_allclose(out["v"], again["v"], rtol=1e-13)
    known = frame["v"].notna()
    np.testing.assert_array_equal(out["v"][known], frame["v"][known])
    for g, part in frame.groupby("g"):
        drawn = out["v"][(out["g"] == g) & ~known]
        z = (drawn - part["v"].median()) / (0.1 * part["v"].std())
        assert abs(z.mean()) < 0.1 and abs(z.std() - 1) < 0.1


def test_noise_bounds_and_unknown_deviation(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "a", None), (3, "b", 7.0), (4, "b", 7.0), (5, "b", None)], DDL)
    got = dict(rows(I.impute_median(df, "v", "g", I.Noise("id")).select("id", "v")))
    assert abs(got[2] - 5) < 0.5 and got[2] != 5 and abs(got[5] - 7) < 0.5
    bounded = I.Noise("id", share=1.0, fallback=500.0, zero_is_unknown=False, bounds=(4.0, 6.0))
    got = dict(rows(I.impute_median(df, "v", "g", bounded).select("id", "v")))
    assert got[2] in (4.0, 6.0)


def test_group_transform_leaves_null_keys_without_a_total(spark):
    df = spark.createDataFrame(DATA, DDL)
    got = dict(rows(I.group_transform(df, "g", s=F.sum("v")).select("id", "s")))
    assert got[1] == 4.0 and got[7] is None


def test_draws_look_normal(spark):
    z = spark.range(100_000).select(I.normal_draw(F.col("id"), "1|x").alias("z"))
    mean, sd, big = z.agg(F.avg("z"), F.stddev("z"), F.avg((F.abs("z") > 1.96).cast("int"))).first()
    assert mean == pytest.approx(0, abs=0.01) and sd == pytest.approx(1, abs=0.01)
    assert big == pytest.approx(0.05, abs=0.003)
