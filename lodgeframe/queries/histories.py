"""Entity histories, records and files, on the events."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.operators import aggregates as A
from lodgeframe.operators.quality import Rule
from lodgeframe.operators.quantiles import group_mode
from lodgeframe.operators.windows import change_flags, monthly_changes
from lodgeframe.queries.registry import Tables, query, r6, text
from lodgeframe.session import scratch_path
from lodgeframe.sources.sinks import avro_schema, payload_columns, peek_records, write_records
from lodgeframe.sources.tables import read_csv, read_stage, update_stage, write_csv, write_stage
from lodgeframe.streaming.publish import publish_stream
from lodgeframe.streaming.unique import unique_stream


@query(
    "change_flags",
    """SELECT event_id, coalesce(event_type <> lag(event_type) OVER w, true) AS event_type_changed,
      coalesce(k <> lag(k) OVER w, true) AS k_changed
    FROM (SELECT event_id, event_type, CASE WHEN event_id % 17 <> 0 THEN ts END AS ts,
        -- rows without a user have no history, so each is a group of its own
        CASE WHEN event_id % 13 <> 0 THEN CAST(user_id AS VARCHAR) ELSE 'none ' || event_id END AS user_key,
        CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 5 AS k FROM events)
    WINDOW w AS (PARTITION BY user_key ORDER BY ts NULLS FIRST, event_id)""",
)
def changes(t: Tables) -> DataFrame:
    df = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint") % 5)
    ts, user = F.when(F.col("event_id") % 17 != 0, F.col("ts")), F.when(F.col("event_id") % 13 != 0, F.col("user_id"))
    df = df.select("event_id", ts.alias("ts"), user.alias("user_id"), "event_type", "k")
    flags = change_flags(df, "user_id", ["ts", "event_id"], ["event_type", "k"])
    return flags.select("event_id", "event_type_changed", "k_changed")


@query(
    "monthly_changes",
    """SELECT strftime(ts, '%Y-%m-01') AS month, count(*) FILTER (n > 1) AS n_changed FROM (
      SELECT date_trunc('month', ts) AS ts, user_id, count(DISTINCT event_type) AS n FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def monthly(t: Tables) -> DataFrame:
    table = monthly_changes(t.events.withColumn("day", F.col("ts").cast("date")), "user_id", "day", "event_type")
    return table.select(text("month").alias("month"), "n_changed")


@query(
    "entity_rate",
    "SELECT user_id, round(avg(CAST(event_type = 'purchase' AS INT)), 6) AS rate, count(*) AS n FROM events GROUP BY user_id",
)
def entity_rate(t: Tables) -> DataFrame:
    table = A.entity_rate(t.events, "user_id", F.col("event_type") == "purchase")
    return table.select("user_id", r6("rate").alias("rate"), "n")


@query(
    "nunique_by",
    "SELECT event_type, count(DISTINCT user_id) AS n_user_id, count(DISTINCT value) AS n_value FROM events GROUP BY event_type",
)
def nunique_by(t: Tables) -> DataFrame:
    return A.nunique_by(t.events, ["event_type"], ["user_id", "value"])


@query(
    "first_per_group",
    "SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_event_type, arg_min(value, (ts, event_id)) AS first_value FROM events GROUP BY user_id",
)
def first_per_group(t: Tables) -> DataFrame:
    return A.first_per_group(t.events, "user_id", ["event_type", "value"], ["ts", "event_id"])


@query(
    "mode_by",
    """SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS r
    FROM events GROUP BY user_id, event_type) WHERE r = 1""",
)
def mode_by(t: Tables) -> DataFrame:
    return group_mode(t.events, "event_type", ["user_id"], "event_type")


@query(
    "mode_global",
    "SELECT event_type FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1",
)
def mode_global(t: Tables) -> DataFrame:
    return group_mode(t.events, "event_type", out="event_type")


@query(
    "consistency_checks",
    """WITH c AS (SELECT value >= 0 AS a, value < 10 AS b, CASE WHEN event_id % 7 <> 0 THEN user_id <= event_id END AS c FROM events)
    SELECT 'non_negative' AS check_name, bool_and(a) AS holds, round(avg(CAST(a AS INT)), 6) AS share FROM c
    UNION ALL SELECT 'below_ten', bool_and(b), round(avg(CAST(b AS INT)), 6) FROM c
    UNION ALL SELECT 'ordered', bool_and(coalesce(c, false)), round(avg(CAST(coalesce(c, false) AS INT)), 6) FROM c""",
)
def consistency_checks(t: Tables) -> DataFrame:
    known = F.when(F.col("event_id") % 7 != 0, F.col("user_id"))
    table = A.consistency(
        t.events,
        {
            "non_negative": F.col("value") >= 0,
            "below_ten": F.col("value") < 10,
            "ordered": known <= F.col("event_id"),
        },
    )
    return table.select("check_name", "holds", r6("share").alias("share"))


@query(
    "publish_payload",
    """SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value, props FROM events""",
)
def publish_payload(t: Tables) -> DataFrame:
    """NaN values stand in for the missing ones and must come out as null."""
    value = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return payload_columns(t.events.withColumn("value", value))


@query(
    "avro_schema_fields",
    """SELECT name, avro_type, n FROM (VALUES ('event_id', 'long'), ('ts', 'timestamp-millis'), ('user_id', 'long'),
      ('event_type', 'string'), ('value', 'double'), ('props', 'string')) v(name, avro_type), (SELECT count(*) AS n FROM events)""",
)
def avro_schema_fields(t: Tables) -> DataFrame:
    """The record schema, with the number of values each field will carry."""
    fields = json.loads(avro_schema(t.events, "events"))["fields"]
    cells = []
    for field in fields:
        kind = field["type"][1]
        label = kind["logicalType"] if isinstance(kind, dict) else kind
        cells.append(
            F.struct(
                F.lit(field["name"]).alias("name"),
                F.lit(label).alias("avro_type"),
                F.count(field["name"]).alias("n"),
            )
        )
    return t.events.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query("src_csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def src_csv_roundtrip(t: Tables) -> DataFrame:
    """Texts with line breaks and quotes through CSV files and back."""
    path = write_csv(t.documents, scratch_path(t.spark, "csv"))
    return read_csv(t.spark, path, t.documents.schema)


@query(
    "stage_update",
    """WITH o AS (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus, o_totalprice FROM orders),
    again AS (SELECT * FROM o WHERE year % 2 = 1 AND o_orderstatus = 'F'),
    stage AS (SELECT * FROM o WHERE year IS NULL OR year NOT IN (SELECT year FROM again) UNION ALL SELECT * FROM again),
    rewritten AS (SELECT year, count(*) AS rewritten FROM again GROUP BY year)
    SELECT year, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi, any_value(rewritten) AS rewritten
    FROM stage LEFT JOIN rewritten USING (year) GROUP BY year""",
)
def stage_update(t: Tables) -> DataFrame:
    """Orders staged by year; of odd years only finished orders are handed over again, which replaces those years."""
    path = scratch_path(t.spark, "orders")
    orders = t.orders.select(F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice")
    write_stage(orders, path, ["year"])
    again = orders.where((F.col("year") % 2 == 1) & (F.col("o_orderstatus") == "F"))
    rewritten = update_stage(again, path, ["year"]).withColumnRenamed("n", "rewritten")
    prices = [F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")]
    years = read_stage(t.spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("n"), *prices)
    return years.join(rewritten, "year", "left")


@query(
    "sink_roundtrip",
    "SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value FROM events",
)
def sink_roundtrip(t: Tables) -> DataFrame:
    """All events as JSON records in the file sink, decoded again."""
    path = scratch_path(t.spark, "records")
    df = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    write_records(df, path, "json")
    values = t.spark.read.text(path)
    decoded = values.select(F.from_json("value", payload_columns(df).schema).alias("r"))
    return decoded.select("r.*")


@query(
    "sink_peek",
    "SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id, event_type, value FROM events ORDER BY event_id LIMIT 10",
)
def sink_peek(t: Tables) -> DataFrame:
    """The first ten records of the file sink by id."""
    path = scratch_path(t.spark, "records")
    df = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    write_records(df, path, "json")
    return peek_records(t.spark, path, payload_columns(df).schema, 10, order=["event_id"])


@query(
    "publish_stream",
    """SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type = 'purchase' AS booked, 0 AS n_errors
    FROM events UNION ALL SELECT NULL, NULL, NULL, NULL, 1 WHERE EXISTS (SELECT 1 FROM events WHERE value <= 0 OR value >= 50)""",
)
def stream(t: Tables) -> DataFrame:
    """Events as a file stream into gold rows, with one line per dead letter."""
    spark, base = t.spark, scratch_path(t.spark, "stream")
    source = (
        spark.readStream.schema(t.events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(t.path)
    )

    def transform(df: DataFrame) -> DataFrame:
        return df.select(
            "event_id",
            "user_id",
            text(F.col("ts").cast("date")).alias("day"),
            (F.col("event_type") == "purchase").alias("booked"),
            "value",
        )

    rules = [
        Rule("range", "value out of range", "value", (0, 50)),
        Rule("not_null", "user missing", "user_id"),
    ]
    publish_stream(
        source, transform, rules, f"{base}/gold", f"{base}/errors", f"{base}/progress"
    ).awaitTermination()
    gold = spark.read.parquet(f"{base}/gold").drop("batch_id", "value")
    errors = spark.read.text(f"{base}/errors").select(F.lit(1).alias("n_errors"))
    return gold.withColumn("n_errors", F.lit(0)).unionByName(errors, allowMissingColumns=True)


@query(
    "unique_stream",
    """WITH e AS (SELECT user_id || '-' || event_type AS key, epoch_us(ts) // 3600000000 AS hour FROM events),
    w AS (SELECT key, unnest([hour, hour - 1]) AS hour FROM e)
    SELECT DISTINCT 'key=' || key AS variable, 'Duplicate key found in the stream' AS message
    FROM (SELECT key FROM w GROUP BY key, hour HAVING count(*) > 1)""",
)
def unique_over_the_stream(t: Tables) -> DataFrame:
    """Dead letters of users that do the same thing twice within an hour."""
    spark, base = t.spark, scratch_path(t.spark, "unique")
    files = spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.path)
    source = files.select("event_id", "ts", F.concat_ws("-", "user_id", "event_type").alias("key"))
    unique_stream(source, "key", "ts", 3600, f"{base}/errors", f"{base}/progress").awaitTermination()
    letters = spark.read.schema("value string").text(f"{base}/errors")
    record = F.from_json("value", "variable string, message string")
    return letters.select(record.alias("r")).select("r.variable", "r.message").distinct()
