"""A training corpus from raw documents: language, near duplicates, benchmark passages, personal data, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm import bpe, decontaminate, language, pii, simhash
from lodgeframe.llm.names import free_name
from lodgeframe.llm.queries import vocabulary
from lodgeframe.session import scratch_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that have a language: those without text or without a letter go.

    ``lang`` becomes the predicted one. Nothing is learned from the held-out fold.
    """
    samples = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    p = free_name("_p", docs.columns)
    told = docs.withColumn(p, language.language(spark, F.col("text"), samples))
    if not samples.texts:  # nothing labelled: only whether there is a letter can be told
        return docs.where(F.col("text").rlike(r"\p{L}"))
    kept = told.where(F.col(p)["lang"] != language.UNDETERMINED)
    return kept.withColumn("lang", F.col(p)["lang"]).drop(p)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents; a few quoted words do not make one contaminated."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    k, r, own = (free_name(n, docs.columns) for n in ("_k", "_r", "_own"))
    bad = found.where("contaminated").select(F.col("doc_id").alias(k), F.col("row_hash").alias(r)).distinct()
    told = docs.withColumn(own, F.xxhash64("text"))
    return told.join(bad, F.col("doc_id").eqNullSafe(F.col(k)) & (F.col(own) == F.col(r)), "left_anti").drop(own)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span by its kind in brackets; ``n_chars`` follows the text."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text; only documents whose ids decode to their bytes again would be right, so others raise."""
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), vocabulary(VOCABULARY))
    same = F.col("bytes") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    checked = F.when(same, F.size("ids").cast("long")).otherwise(
        F.raise_error(F.concat(F.lit("ids of document "), F.col("doc_id").cast("string"))).cast("long")
    )
    return coded.select("doc_id", "lang", "source", "ids", checked.alias("n_tokens"))


STAGES = [
    ("language", by_language),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("tokens", as_tokens),
]

ORACLE_SQL = None  # fingerprints and predictions have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
