from __future__ import annotations

from pyspark.sql import functions as F

from lodgeframe.llm import exactdedup as X
from lodgeframe.session import scratch_path
from tests.helpers import plan
from tests.llm.cases import DOCS, LONG, SCHEMA, documents, empty


def table(spark, df, parts=3, path=None):
    path = path or scratch_path(spark, "dedup-input")
    df.repartition(parts).write.mode("append").parquet(path)
    return path


def plain(docs):
    """(key, keep, size) of every row, and how many rows stay."""
    groups = {}
    for d in docs:
        groups.setdefault(d[1] or "", []).append(d[0])
    order = lambda k: (k is not None, k or 0)
    return sorted(((d[0], max(groups[d[1] or ""], key=order), len(groups[d[1] or ""])) for d in docs), key=str), len(groups)


def check(df, docs):
    rows = df.collect()
    want, texts = plain(docs)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in rows), key=str) == want
    assert sum(r.kept for r in rows) == texts and all(r.doc_id == r.keep_id for r in rows if r.kept)


MORE = [*DOCS, (20, "no key at all", "en", "b", 3, 1.0), (None, None, "en", "b", 3, 1.0), (21, LONG, None, None, None, None), (21, "x", None, None, None, None)]


def test_all_cases(spark):
    path = table(spark, spark.createDataFrame(MORE, SCHEMA))
    found = X.deduplicate(spark, path)
    check(found, MORE)
    sums = {r.doc_id: r.text_sha256 for r in found.collect()}
    want = {r.doc_id: r.s for r in spark.createDataFrame(MORE, SCHEMA).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("s")).collect()}
    assert {k: v for k, v in sums.items() if k not in (None, 21, 7)} == {k: v for k, v in want.items() if k not in (None, 21, 7)}


def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark):
    path = table(spark, spark.createDataFrame(MORE, SCHEMA))
    check(X.deduplicate(spark, path, digest=lambda t: F.substring(t, 1, 1)), MORE)


def test_the_state_goes_on_with_new_files(spark):
    path, state = table(spark, documents(spark)), scratch_path(spark, "dedup-state")
    check(X.deduplicate(spark, path, state), DOCS)
    check(X.deduplicate(spark, path, state), DOCS)  # nothing new: nothing counts twice
    later = [(30, DOCS[0][1], "en", "a", 1, 1.0), (0, "", "en", "a", 1, 1.0), (31, "new", "en", "a", 1, 1.0)]
    table(spark, spark.createDataFrame(later, SCHEMA), 2, path)
    check(X.deduplicate(spark, path, state), [*DOCS, *later])
    assert X.update_state(spark, path, state).agg(F.sum("n")).first()[0] == len(DOCS) + len(later)


def test_a_hot_text_and_one_batch(spark):
    docs = [(i, "same" if i % 3 else f"own {i}") for i in range(3000)]
    path = table(spark, spark.createDataFrame(docs, "doc_id long, text string"), 7)
    check(X.deduplicate(spark, path, batches=1), docs)


def test_empty_tables(spark):
    assert X.deduplicate(spark, table(spark, empty(spark), 1)).count() == 0
    path = scratch_path(spark, "dedup-input")
    spark.createDataFrame([], SCHEMA).limit(0).write.parquet(path)
    assert X.deduplicate(spark, path).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_no_python_runs_on_rows(spark):
    found = X.deduplicate(spark, table(spark, documents(spark)))
    assert not any(word in plan(found) for word in ("Python", "Pandas", "Arrow"))
