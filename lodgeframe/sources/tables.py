"""CSV in, Parquet stages in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeframe.session import scratch_path


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool = True,
    infer: bool = False,
) -> DataFrame:
    """UTF-8 CSV with a header and quoted text that may span lines.

    Columns are found by header name, as files order them freely: the header is read as text and
    then cast to the schema. Quoted line breaks keep a file whole, so ship such data as many files;
    pass ``multiline=False`` where texts hold none, and files are split. Without a schema all columns are
    text, or with ``infer`` of the type that their values have, which takes one more pass.
    """
    infer = infer and schema is None
    reader = spark.read.options(header=True, multiLine=multiline, inferSchema=infer, quote='"', escape='"', encoding="UTF-8")
    table = reader.csv(path)
    return table if schema is None else conform(table, schema)


def conform(table: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns by name; unreadable values and missing columns become null."""
    def column(field: T.StructField):
        if field.name not in table.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            # Counts are sometimes written as "3.0".
            text = F.regexp_replace(text.cast("string"), r"\.0+$", "")
        return text.try_cast(field.dataType).alias(field.name)

    return table.select(*[column(f) for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', encoding="UTF-8").csv(path)
    return path


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Hand a stage over as Parquet."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def update_stage(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Replace the partitions of a stage that ``df`` has rows of, and return (partition columns, n): what was rewritten.

    All other partitions stay as they are, so a rerun of one month writes that month only. The rows are written
    aside first: ``df`` may read the stage that it updates, rows that cannot be computed leave the stage as it was, and
    readers can meet a change only while finished folders are moved in, one by one. An empty ``df`` changes nothing. Null and the
    empty text are one partition, as in all folders that Spark names by value.
    """
    if not partition_by:
        raise ValueError("a stage is updated by its partition columns")
    spark = df.sparkSession
    aside = scratch_path(spark, "stage")
    df.write.partitionBy(*partition_by).parquet(aside)
    rows = spark.read.schema(df.schema).parquet(aside).select(*[f"`{c}`" for c in df.columns])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return rows.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n"))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def extract(spark: SparkSession, csv_path: str, stage_path: str, schema: T.StructType) -> DataFrame:
    """Raw CSV to a Parquet stage, read back."""
    write_stage(read_csv(spark, csv_path, schema), stage_path)
    return read_stage(spark, stage_path)
