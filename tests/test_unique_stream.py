from __future__ import annotations

import datetime as dt
import json

from lodgeframe.streaming.unique import unique_stream

START = dt.datetime(2026, 4, 1, 12)


def at(minutes: float) -> dt.datetime:
    return START + dt.timedelta(minutes=minutes)


def put(spark, path, batch):
    spark.createDataFrame(batch, "id string, ts timestamp, n int").coalesce(1).write.mode("append").parquet(path)


def run(spark, base, delay=600):
    source = spark.readStream.schema("id string, ts timestamp, n int").parquet(f"{base}/in")
    unique_stream(source, "id", "ts", delay, f"{base}/errors", f"{base}/progress").awaitTermination()
    letters = spark.read.schema("value string").text(f"{base}/errors").collect()
    return sorted(json.loads(r.value)["variable"] for r in letters)


def test_a_duplicate_in_a_later_batch_gives_a_dead_letter(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", [("a", at(0), 1), ("b", at(1), 1), ("c", at(1), 1), (None, at(1), 1), ("z", None, 1), ("z", None, 2)])
    assert run(spark, base) == []
    put(spark, f"{base}/in", [("a", at(2), 2), ("d", at(3), 1), ("d", at(3), 2), (None, at(4), 2)])
    assert run(spark, base) == ["id=a", "id=d", "id=null"]
    assert run(spark, base) == ["id=a", "id=d", "id=null"]  # nothing new: nothing is lost and nothing is repeated
    # over the border of a window, and long after
    put(spark, f"{base}/in", [("e", at(9.9), 1), ("f", at(10), 1)])
    put(spark, f"{base}/in", [("e", at(10.1), 2), ("b", at(300), 2)])
    assert run(spark, base) == ["id=a", "id=d", "id=e", "id=null"]


def test_a_hot_key_in_one_batch(spark, tmp_path):
    base = str(tmp_path)
    put(spark, f"{base}/in", [("hot", at(i / 100), i) for i in range(500)] + [(f"k{i}", at(1), i) for i in range(50)])
    assert run(spark, base) == ["id=hot"]
