from __future__ import annotations

import datetime as dt
import random

import pytest

from lodgeframe.operators.lookups import range_join
from tests.helpers import plan, rows

DAY = dt.datetime(2024, 3, 30, 22)


def times(spark, kind: str, seed: int = 1):
    rng = random.Random(seed)
    at = [DAY + dt.timedelta(seconds=rng.randint(-400 * 86400, 400 * 86400) if i % 4 else rng.randint(0, 7200)) for i in range(300)]
    points = [(i, t) for i, t in enumerate([*at, None, at[0], at[0], DAY.replace(microsecond=1)])]
    ends = [(i, a := rng.choice(at), a + dt.timedelta(seconds=rng.choice([0, 1, 59, 600, 86400, 300 * 86400, 900 * 86400]))) for i in range(80)]
    ends += [(90, None, DAY), (91, DAY, None), (92, DAY, DAY - dt.timedelta(seconds=1)), (93, DAY, DAY), (94, ends[0][1], ends[0][2])]
    convert = (lambda t: t and t.date()) if kind == "date" else lambda t: t
    points = [(i, convert(t)) for i, t in points]
    ends = [(i, convert(a), convert(b)) for i, a, b in ends]
    frame = spark.createDataFrame(points, f"id int, at {kind}"), spark.createDataFrame(ends, f"w int, start {kind}, end {kind}")
    want = sorted((i, w) for i, t in points for w, a, b in ends if None not in (t, a, b) and a <= t <= b)
    return *frame, want


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
@pytest.mark.parametrize("widths", [[60, 3600, 86400 * 30], [86400 * 365]])
def test_windows_from_seconds_to_years(spark, kind, widths):
    points, windows, want = times(spark, kind)
    assert rows(range_join(points.repartition(5), "at", windows, [7, 90] if kind == "date" else widths).select("id", "w"), "id", "w") == want


def test_numbers_on_both_sides_of_zero(spark):
    points = spark.range(-50, 50).withColumnRenamed("id", "x")
    windows = spark.createDataFrame([(-7, -1), (-1, 0), (3, 3), (-60, 60), (40, 400), (5, 4)], "start long, end long")
    found = range_join(points, "x", windows, [1, 8])
    assert rows(found, "start", "x") == sorted(
        ((x, a, b) for a, b in [(-7, -1), (-1, 0), (3, 3), (-60, 60), (40, 400)] for x in range(-50, 50) if a <= x <= b), key=lambda r: (r[1], r[0])
    )
    assert "CartesianProduct" not in plan(found) and "BroadcastNestedLoopJoin" not in plan(found)


def test_windows_of_mixed_lengths(spark):
    points = spark.range(5).withColumnRenamed("id", "x")
    windows = spark.range(1000).selectExpr("id AS start", "id + id % 100 AS end")
    laid = range_join(points, "x", windows, [10, 100])
    assert laid.count() == sum(s <= x <= s + s % 100 for x in range(5) for s in range(1000))


def test_empty_sides_and_wrong_arguments(spark):
    points, windows, _ = times(spark, "date")
    assert range_join(points.limit(0), "at", windows, [1]).count() == range_join(points, "at", windows.limit(0), [1]).count() == 0
    for widths in ([], [0], [5, 5], [9, 3]):
        with pytest.raises(ValueError):
            range_join(points, "at", windows, widths)
    with pytest.raises(TypeError):
        range_join(points, "id", windows, [1])
