"""Cleaning steps on whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodgeframe.functions.clean import every_of, is_true
from lodgeframe.operators.quantiles import quantile_row
from lodgeframe.operators.sizing import one_row


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The listed columns the table has."""
    return [c for c in columns if c in df.columns]


def on_columns(df: DataFrame, columns: Sequence[str], fn) -> DataFrame:
    """Apply a Column function to every listed column the table has."""
    return df.withColumns({c: fn(F.col(c)) for c in present(df, columns)})


def translate_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace listed values, keep the rest."""
    return df.replace(dict(mapping), subset=[column]) if column in df.columns else df


def override_by_id(
    df: DataFrame, id_column: str, ids: Sequence | DataFrame, target: str, value
) -> DataFrame:
    """Set a column to a constant for the listed ids (a list, or a table with the id column)."""
    if not isinstance(ids, DataFrame):
        kind = df.schema[id_column].dataType
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], f"{id_column} {kind.simpleString()}")
    marks = ids.select(id_column).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(marks, id_column, "left")
    changed = F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(target))
    return joined.withColumn(target, changed).select(*df.columns)


def override_if_all_null(
    df: DataFrame, id_column: str, values: Mapping[object, object], target: str
) -> DataFrame:
    """Set per-id values, but only if the target is null on every listed row."""
    listed = is_true(F.col(id_column).isin(*values))
    guard = one_row(df.where(listed), ok=F.coalesce(F.every(F.col(target).isNull()), F.lit(True)))
    chain = F
    for key, value in values.items():
        chain = chain.when(F.col(id_column) == F.lit(key), F.lit(value))
    return df.withColumn(
        target, F.when(listed & guard["ok"], chain).otherwise(F.col(target))
    )


def reconcile_columns(
    df: DataFrame, declared: str, parsed: str, out: str, max_mismatch: float = 0.1
) -> DataFrame:
    """Adopt the parsed column if few rows disagree, else only fill the gaps with it."""
    differs = is_true(F.col(declared) != F.col(parsed))
    share = one_row(df, share=F.avg(differs.cast("int")))["share"]
    merged = F.when(share < max_mismatch, F.col(parsed)).otherwise(F.coalesce(declared, parsed))
    return df.withColumn(out, merged)


def log1p_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """log(1 + x) into ``<column>_log`` for the listed columns the table has."""
    return df.withColumns({f"{c}_log": F.log1p(F.col(c)) for c in present(df, columns)})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; an existing column with a new name gives way."""
    clashing = [new for old, new in mapping.items() if old in df.columns and new != old]
    return df.drop(*clashing).withColumnsRenamed(dict(mapping))


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Null share of every column as one array of (column_name, share), from one pass."""
    return F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.avg(F.col(f"`{c}`").isNull().cast("double")).alias("share"),
            )
            for c in (columns or df.columns)
        ]
    )


def drop_high_null(df: DataFrame, max_share: float = 0.8) -> DataFrame:
    """Drop columns whose null share exceeds the bound (one scan, one row read)."""
    shares = df.agg(null_shares(df).alias("shares")).first()["shares"]
    return df.drop(*[s["column_name"] for s in shares if s["share"] > max_share])


def drop_null_rows(
    df: DataFrame, columns: Sequence[str], counts: Observation | None = None
) -> DataFrame:
    """Drop rows with a null key column; ``counts`` receives rows_in and rows_kept."""
    if counts is not None:
        kept = every_of([F.col(c).isNotNull() for c in columns])
        df = df.observe(
            counts, F.count(F.lit(1)).alias("rows_in"), F.count_if(kept).alias("rows_kept")
        )
    return df.dropna(subset=list(columns))


def require_schema(df: DataFrame, columns: Sequence[str], unique: str | None = None) -> DataFrame:
    """Fail at once on missing columns, and when run on a repeated id."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if unique is None:
        return df
    repeated = df.groupBy(unique).count().where("count > 1")
    found = one_row(repeated, n=F.count(F.lit(1)))["n"]
    problem = F.concat(F.lit(f"{unique} repeated: "), found.cast("string"))
    checked = F.when(found == 0, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    return df.where(checked)


def trim_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Rows strictly below the column's quantile."""
    return df.where(F.col(column) < quantile_row(df, column, {"bound": q})["bound"])


def filter_valid(df: DataFrame, masks: Mapping[str, Column], counts: Observation | None = None) -> DataFrame:
    """Rows that meet every named mask; ``counts`` receives the failures per mask."""
    if counts is not None:
        failed = [F.count_if(~is_true(m)).alias(f"failed_{n}") for n, m in masks.items()]
        df = df.observe(counts, F.count(F.lit(1)).alias("rows_in"), *failed)
    return df.where(every_of(list(masks.values())))


def optional(mask: Column, c: Column) -> Column:
    """The mask, with a missing value let through."""
    return mask | c.isNull()


def row_failures(df: DataFrame, masks: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """Rows that break a mask, with the names of the broken ones."""
    names = F.array_compact(
        F.array(*[F.when(~is_true(m), F.lit(n)) for n, m in masks.items()])
    )
    return df.select(*keep, names.alias("failures")).where(F.size("failures") > 0)


def _digest(columns: Sequence[str]) -> Column:
    """256 bits of a row: equal rows and no others share it. Lengths and nulls are part of it."""
    parts = [F.to_json(F.struct(F.col(c).alias("v"))) for c in columns]
    return F.unhex(F.sha2(F.concat_ws("\n", *parts), 256))


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop repeated rows. A digest is the shuffle key, so that long texts are not compared."""
    kept = df.groupBy(_digest(df.columns).alias("_d")).agg(F.any_value(F.struct(*df.columns)).alias("_row"))
    return kept.select("_row.*")


def dedup_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key in ``order``, as an aggregate: partials shrink hot keys early."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and surplus rows over the columns (all unless given)."""
    counted = df.groupBy(_digest(columns or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(
        F.sum("_n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.col("_n") - 1).alias("n_duplicates"),
    )
