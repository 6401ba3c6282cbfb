from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest

from lodgeframe.operators.lookups import totals_after
from lodgeframe.queries import QUERIES, Tables
from tests.compare import differences
from tests.helpers import plan, rows

DAY = dt.datetime(2024, 3, 30, 22)


@pytest.fixture(params=[True, False], ids=["one slice", "many slices"])
def slices(spark, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(request.param).lower())
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain(points, windows, length):
    found = []
    for w, a in windows:
        inside = [(v, u) for at, v, u in points if None not in (at, a) and a <= at <= a + length]
        known = [v for v, _ in inside if v is not None]
        if inside:
            found.append((w, a, len(inside), sum(known) if known else None, len({u for _, u in inside} - {None})))
    return sorted(found)


@pytest.mark.parametrize("length, spread", [(1, 40), (7, 40), (60, 40), (5, 4000)])
def test_against_all_pairs(spark, slices, length, spread):
    rng = random.Random(length + spread)
    points = [(rng.randint(-spread, spread), rng.choice([None, 1, 5, -3]), rng.choice([None, *range(9)])) for _ in range(500)]
    points += [(None, 1, 1), *[(3, 2, 8)] * 40]
    windows = [(i, rng.randint(-spread - 70, spread + 9)) for i in range(200)] + [(300, None), (301, 3), (301, 3), (302, 3 - length)]
    df = spark.createDataFrame(points, "x long, v long, u long").repartition(5)
    found = totals_after(df, "x", spark.createDataFrame(windows, "w int, start long"), length, {"s": "v"}, {"k": "u"})
    assert rows(found.select("w", "start", "n", "s", "k"), "w") == plain(points, windows, length)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_times(spark, kind):
    rng = random.Random(2)
    step = dt.timedelta(days=1) if kind == "date" else dt.timedelta(microseconds=500_000)
    convert = (lambda t: t.date()) if kind == "date" else lambda t: t
    points = [(convert(DAY + rng.randint(0, 300) * step), 0.25, rng.randint(0, 5)) for _ in range(200)]
    windows = [(i, convert(DAY + rng.randint(-20, 300) * step)) for i in range(60)]
    df, asked = spark.createDataFrame(points, f"x {kind}, v double, u int"), spark.createDataFrame(windows, f"w int, start {kind}")
    found = totals_after(df, "x", asked, 4, {"s": "v"}, {"k": "u"}).select("w", "start", "n", "s", "k")
    assert rows(found, "w") == plain(points, windows, 4 * dt.timedelta(days=1) if kind == "date" else dt.timedelta(seconds=4))


def test_infinite_values_stay_in_their_windows(spark):
    df = spark.createDataFrame([(x, float("inf") if x == 5 else 1.0) for x in range(20)], "x long, v double")
    found = totals_after(df, "x", spark.range(20).withColumnRenamed("id", "start"), 2, {"s": "v"})
    assert [r.s for r in found.orderBy("start").collect()] == [float("inf") if a <= 5 <= a + 2 else float(min(3, 20 - a)) for a in range(20)]


def test_empty_sides_and_wrong_arguments(spark):
    df, starts = spark.range(5).withColumnRenamed("id", "x"), spark.range(5).withColumnRenamed("id", "start")
    assert totals_after(df.limit(0), "x", starts, 2).count() == totals_after(df, "x", starts.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        totals_after(df, "x", starts, 0)
    with pytest.raises(TypeError):
        totals_after(df, "x", starts.selectExpr("DATE '2024-01-01' AS start"), 2)


def test_query_with_shared_ids_and_no_row_for_each_pair(spark, tmp_path):
    con = duckdb.connect()
    con.execute("""COPY (SELECT CASE WHEN i %% 17 = 0 THEN NULL WHEN i %% 5 = 0 THEN i - 5 ELSE i END AS event_id,
      TIMESTAMP '2024-01-01' + INTERVAL (CASE WHEN i %% 2 = 0 THEN 0 ELSE i END) SECOND AS ts, CASE WHEN i %% 13 = 0 THEN NULL ELSE i %% 11 END AS user_id,
      CASE WHEN i %% 3 = 0 THEN 'purchase' ELSE 'view' END AS event_type, CASE WHEN i %% 7 = 0 THEN NULL ELSE i / 4 END AS value, '' AS props
      FROM range(3000) r(i)) TO '%s' (FORMAT parquet)""" % (tmp_path / "events.parquet"))
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    query = QUERIES["range_join_minutes"]
    found = query.run(Tables(spark, str(tmp_path)))
    assert differences(found, con, query.sql) == []
    # pairs are formed for ids with many windows only, so the sums do not come from them
    assert "left_semi" in plan(found).lower().replace("leftsemi", "left_semi")
