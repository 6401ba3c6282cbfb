from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lodgeframe.operators.quality import Rule
from lodgeframe.plans import calendar, listings, reviews
from lodgeframe.session import checkpointed, scratch_path, shared_dir, shuffle_partitions
from lodgeframe.sources import schemas, sinks, tables
from lodgeframe.streaming.publish import publish_stream
from tests.helpers import rows


def test_csv_round_trip_with_breaks_and_quotes(spark, tmp_path):
    data = [(1, 'He said "hi",\nthen left', 1.5), (2, None, None), (3, "plain", 2.0)]
    df = spark.createDataFrame(data, "id bigint, t string, v double")
    back = tables.read_csv(spark, tables.write_csv(df, str(tmp_path / "c")), df.schema)
    assert rows(back, "id") == data


def test_csv_header_order_types_and_missing_columns(spark, tmp_path):
    (tmp_path / "c.csv").write_text('date,listing_id,minimum_nights,available\n2025-01-02,7,3.0,t\nx,nine,4,f\n', encoding="utf-8")
    got = tables.read_csv(spark, str(tmp_path / "c.csv"), schemas.CALENDAR)
    assert got.columns == schemas.CALENDAR.fieldNames()
    assert rows(got.select("listing_id", "date", "minimum_nights", "price"), "date") == [(7, "2025-01-02", 3, None), (None, "x", 4, None)]


def test_extract_stages_parquet(spark, tmp_path):
    (tmp_path / "r.csv").write_text('listing_id,id,date,reviewer_id,reviewer_name,comments\n1,2,2024-05-06,3,Ann,"<b>Nice</b>\nstay"\n')
    raw = tables.extract(spark, str(tmp_path / "r.csv"), str(tmp_path / "stage"), schemas.REVIEWS)
    (row,) = reviews.gold(raw).collect()
    assert row["comments_clean"] == "nice stay" and row["review_year"] == 2024 and "reviewer_name" not in row


def test_partitioned_stage_prunes(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, 6)], "id int, month int")
    tables.write_stage(df, str(tmp_path / "s"), ["month"])
    got = tables.read_stage(spark, str(tmp_path / "s")).where("month = 5")
    assert rows(got.select("id")) == [(1,)]


def test_a_rerun_replaces_its_partitions_only(spark, tmp_path):
    path = str(tmp_path / "stage")
    first = spark.createDataFrame([(1, "a", "01"), (2, "b", "02"), (3, "c", "02"), (4, "d", None)], "id long, v string, month string")
    assert {tuple(r) for r in tables.update_stage(first, path, ["month"]).collect()} == {("01", 1), ("02", 2), (None, 1)}
    kept = {p.name: p.read_bytes() for p in (tmp_path / "stage" / "month=01").glob("*.parquet")}
    again = spark.createDataFrame([(2, "new", "02"), (5, "e", "03")], first.schema)
    assert sorted(tuple(r) for r in tables.update_stage(again, path, ["month"]).collect()) == [("02", 1), ("03", 1)]
    stage = spark.read.schema(first.schema).parquet(path)
    want = [(1, "a", "01"), (2, "new", "02"), (4, "d", None), (5, "e", "03")]
    assert sorted(tuple(r) for r in stage.collect()) == want
    assert {p.name: p.read_bytes() for p in (tmp_path / "stage" / "month=01").glob("*.parquet")} == kept

    # rows that are read from the stage itself, no rows at all, a run that fails
    tables.update_stage(stage.where("month = '02'").withColumn("v", F.upper("v")), path, ["month"])
    assert tables.update_stage(stage.limit(0), path, ["month"]).count() == 0
    stage = spark.read.schema(first.schema).parquet(path)  # the files that were replaced are gone
    with pytest.raises(Exception, match="broken"):
        tables.update_stage(stage.withColumn("v", F.raise_error(F.lit("broken")).cast("string")), path, ["month"])
    stage = spark.read.schema(first.schema).parquet(path)
    assert sorted(tuple(r) for r in stage.collect()) == [(1, "a", "01"), (2, "NEW", "02"), (4, "d", None), (5, "e", "03")]
    with pytest.raises(ValueError):
        tables.update_stage(first, path, [])


def test_avro_schema(spark):
    df = spark.createDataFrame([], "a bigint, b int, c double, d boolean, e string, f array<string>, g timestamp, h date, i float, j decimal(5,2)")
    got = json.loads(sinks.avro_schema(df, "gold", "ns"))
    kinds = {f["name"]: f["type"][1] for f in got["fields"]}
    stamp = {"type": "long", "logicalType": "timestamp-millis"}
    assert kinds == {
        "a": "long", "b": "int", "c": "double", "d": "boolean", "e": "string",
        "f": {"type": "array", "items": "string"}, "g": stamp, "h": stamp, "i": "double", "j": "string",
    }
    assert all(f["type"][0] == "null" and f["default"] is None for f in got["fields"])
    assert (got["type"], got["name"], got["namespace"]) == ("record", "gold", "ns")


def test_payload(spark):
    stamp = dt.datetime(1969, 12, 31, 23, 59, 59, 999_000)
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 2), stamp, float("nan"), ["a"]), (None, None, None, None)],
        "d date, t timestamp_ntz, v double, l array<string>",
    )
    assert rows(sinks.payload_columns(df), F.col("d").desc()) == [(1704153600000, -1, None, ["a"]), (None,) * 4]
    texts = [json.loads(r[0]) for r in sinks.json_values(df).collect()]
    assert {"d": None, "t": None, "v": None, "l": None} in texts


def test_file_sinks_and_peek(spark, tmp_path):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id int, name string")
    sinks.write_records(df, str(tmp_path / "j"), "json")
    got = sinks.peek_records(spark, str(tmp_path / "j"), df.schema, 5)
    assert got.count() == 5 and set(rows(got)) <= set(rows(df))
    sinks.write_records(df, str(tmp_path / "p"), "parquet")
    assert sinks.peek_records(spark, str(tmp_path / "p"), df.schema, 50, "parquet").count() == 20
    with pytest.raises(ValueError, match="unknown sink"):
        sinks.write_records(df, "x", "mail")
    if not sinks.has_source(spark, "kafka"):
        with pytest.raises(RuntimeError, match="topic sink needs"):
            sinks.write_records(df, "topic", "kafka", servers="host:1")
    assert sinks.has_source(spark, "parquet")


def test_shared_dir_and_checkpoint(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    df = checkpointed(spark.range(5).withColumn("r", F.rand(1)))
    assert rows(df, "id") == rows(df, "id") and "Range" not in df._jdf.queryExecution().toString()


def test_shuffle_partitions():
    tb = 1024**4
    assert shuffle_partitions(0) == 200 and shuffle_partitions(tb) == 5243
    assert shuffle_partitions(100 * tb) == 524_288


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_local_sessions_get_a_folder_of_their_own():
    from types import SimpleNamespace

    unset = SimpleNamespace(get=lambda key, default: default)
    local = SimpleNamespace(conf=unset, sparkContext=_Context("local[2]"))
    assert shared_dir(local) == shared_dir(local) == local.sparkContext.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=unset, sparkContext=_Context("yarn")))
    named = SimpleNamespace(get=lambda key, default: "hdfs:///shared/")
    assert shared_dir(SimpleNamespace(conf=named, sparkContext=None)) == "hdfs:///shared"


def test_stream_equals_batch(spark, tmp_path):
    source, days = str(tmp_path / "in"), [f"2026-04-{d:02d}" for d in range(1, 21)]
    raw = spark.createDataFrame(
        [(i, d, "t" if i % 2 else "f" if i % 3 else None, None, None, 1, 400) for i, d in enumerate(days)],
        schemas.CALENDAR,
    )
    raw.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(schemas.CALENDAR).option("maxFilesPerTrigger", 2).parquet(source)
    paths = [str(tmp_path / n) for n in ("gold", "errors", "progress")]
    publish_stream(stream, calendar.gold, calendar.rules(), *paths, records_target=str(tmp_path / "records")).awaitTermination()
    gold = spark.read.parquet(paths[0]).drop("batch_id")
    assert sorted(rows(gold), key=str) == sorted(rows(calendar.gold(raw).select(*gold.columns)), key=str)
    errors = [json.loads(r[0])["message"] for r in spark.read.text(paths[1]).select("value").collect()]
    assert set(errors) == {"Invalid format in available column"}
    assert spark.read.text(str(tmp_path / "records")).count() == len(days)
    # Started again on the same progress, the query has nothing left to do.
    publish_stream(stream, calendar.gold, calendar.rules(), *paths).awaitTermination()
    assert spark.read.parquet(paths[0]).count() == len(days)


def test_listing_rules_match_the_gold_columns(spark):
    raw = spark.createDataFrame([], schemas.LISTINGS)
    gold = listings.gold(raw)
    assert {r.column for r in listings.rules() if r.column} <= set(gold.columns)
    assert not set(listings.DROPPED_COLUMNS) & set(gold.columns)
    assert {f"{c}_log" for c in listings.LOG_COLUMNS} <= set(gold.columns)
