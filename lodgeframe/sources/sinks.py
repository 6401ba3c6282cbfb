"""Gold rows as records: schema, payload, and the places they are written to."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAMESPACE = "rental.data"
DAY_MILLIS = 86_400_000

# Producer settings of the topic sink.
TOPIC_OPTIONS = {"kafka.linger.ms": "10", "kafka.compression.type": "snappy"}


def avro_type(kind: T.DataType) -> str | dict:
    """Avro type of a column type; anything without a counterpart is a string."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return {"type": "long", "logicalType": "timestamp-millis"}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": "string"}
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.LongType):
        return "long"
    if isinstance(kind, T.IntegralType):
        return "int"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "double"
    return "string"


def avro_schema(df: DataFrame, record: str, namespace: str = NAMESPACE) -> str:
    """Record schema with every field nullable; read from the table's types, not its rows."""
    fields = [
        {"name": f.name, "type": ["null", avro_type(f.dataType)], "default": None}
        for f in df.schema.fields
    ]
    return json.dumps(
        {"type": "record", "name": record, "namespace": namespace, "fields": fields}
    )


def epoch_millis(c: Column, kind: T.DataType) -> Column:
    """Milliseconds since 1970; zoneless values are taken as UTC."""
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(c)
    days = F.unix_date(c.cast("date")).cast("bigint") * DAY_MILLIS
    if isinstance(kind, T.DateType):
        return days
    seconds = F.extract(F.lit("SECOND"), c)
    return (
        days
        + F.hour(c).cast("bigint") * 3_600_000
        + F.minute(c).cast("bigint") * 60_000
        + F.floor(seconds * 1000).cast("bigint")
    )


def payload_columns(df: DataFrame) -> DataFrame:
    """Rows in record form: times as epoch millis, NaN as null, list items as text."""

    def column(field: T.StructField) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = epoch_millis(c, kind)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
        elif isinstance(kind, T.ArrayType):
            c = c.cast("array<string>")
        elif isinstance(kind, (T.ByteType, T.ShortType)):
            c = c.cast("int")
        elif avro_type(kind) == "string":
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def json_values(df: DataFrame) -> DataFrame:
    """One JSON text per row, with nulls spelt out."""
    rows = payload_columns(df)
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def avro_values(df: DataFrame, record: str, schema_id: int | None = None) -> DataFrame:
    """One Avro binary per row; with ``schema_id`` framed for consumers that look schemas up by number.

    Fixed values: the frame is a zero byte and the number in four bytes, high byte first.
    """
    from pyspark.sql.avro.functions import to_avro

    rows = payload_columns(df)
    value = to_avro(F.struct("*"), avro_schema(df, record))
    if schema_id is not None:
        value = F.concat(F.lit(b"\0" + schema_id.to_bytes(4, "big")), value)
    return rows.select(value.alias("value"))


def has_source(spark: SparkSession, name: str) -> bool:
    """Whether a data source is on the class path."""
    lookup = spark.sparkContext._jvm.org.apache.spark.sql.execution.datasources.DataSource
    try:
        lookup.lookupDataSource(name, spark._jsparkSession.sessionState().conf())
    except Exception:  # the gateway wraps the JVM's ClassNotFound errors
        return False
    return True


def write_records(
    df: DataFrame,
    target: str,
    sink: str = "json",
    record: str = "record",
    servers: str | None = None,
    mode: str = "append",
    schema_id: int | None = None,
) -> None:
    """Publish rows: ``json`` or ``parquet`` files below a path, or ``kafka`` (Avro) to a topic."""
    if sink == "json":
        json_values(df).write.mode(mode).text(target)
    elif sink == "parquet":
        payload_columns(df).write.mode(mode).parquet(target)
    elif sink == "kafka":
        spark = df.sparkSession
        absent = [s for s in ("kafka", "avro") if not has_source(spark, s)]
        if absent or not servers:
            raise RuntimeError(f"topic sink needs servers and the sources {absent or ''}")
        values = avro_values(df, record, schema_id)
        options = {"kafka.bootstrap.servers": servers, "topic": target, **TOPIC_OPTIONS}
        values.write.format("kafka").options(**options).save()
    else:
        raise ValueError(f"unknown sink {sink!r}")


def peek_records(
    spark: SparkSession,
    target: str,
    schema: T.StructType | str,
    n: int = 10,
    sink: str = "json",
    servers: str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """``n`` published records, decoded: the first in ``order``, else those that the storage gives first."""

    def first(df: DataFrame) -> DataFrame:
        return (df.orderBy(*order) if order else df).limit(n)

    if sink == "parquet":
        return first(spark.read.parquet(target))
    if sink == "json":
        raw = spark.read.text(target)
        return first(raw.select(F.from_json("value", schema).alias("r")).select("r.*"))
    options = {"kafka.bootstrap.servers": servers, "subscribe": target, "startingOffsets": "earliest"}
    raw = spark.read.format("kafka").options(**options).load().limit(n)
    if isinstance(schema, str) and schema.lstrip().startswith("{"):
        from pyspark.sql.avro.functions import from_avro

        return raw.select(from_avro("value", schema).alias("r")).select("r.*")
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")
