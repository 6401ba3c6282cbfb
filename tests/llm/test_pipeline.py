"""All stages against plain versions, on the smallest tables."""

from __future__ import annotations

import base64

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from lodgeframe.llm import simhash
from lodgeframe.llm.queries import QUERIES, SQL, vocabulary
from tests.llm.test_language_pii import PLAIN, plain_spans
from tests.llm.test_similarity import plain_components, plain_contamination, plain_print

SF = "/root/testdata/sf0.001"


def plain_mask(text: str) -> str:
    spans = sorted((s, -e, k) for k, found in plain_spans(text).items() for s, e in found)
    out, at = [], 0
    for start, stop, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, -stop)
    return "".join(out) + text[at:]


def test_run(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {k: t for k, t in docs.items() if any(c.isalpha() for c in t or "")}
    prints = {k: plain_print(t) for k, t in kept.items()}
    roots = plain_components(set(prints.values()))
    first: dict[int, int] = {}
    for k in sorted(kept):
        first.setdefault(roots[prints[k]], k)
    kept = {k: kept[k] for k in first.values()}
    bad = {k for k, *_, contaminated in plain_contamination(kept.items(), items) if contaminated}
    kept = {k: plain_mask(t) for k, t in kept.items() if k not in bad}

    import public_tokenizers

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(corpus_pipeline.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.ids, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()}
    assert 0 < len(got) < len(docs) and bad
    assert set(got) == set(kept) and len(PLAIN) == 4
    for k, (ids, n) in got.items():
        assert ids == library.encode_ordinary(kept[k]) and n == len(ids)


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, SF).columns == rows.columns
        assert corpus_pipeline.as_tokens(spark, rows, SF).count() == rows.count()
    assert corpus_pipeline.by_language(spark, docs, SF).count() == 0


def test_registry():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    assert set(SQL) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5


def test_columns_with_names_of_the_stages_own_stay(spark):
    own = ["_own", "_r", "_k", "_spans", "_masked", "_kept", "_row", "_p"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    more = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in own})
    for name, stage in corpus_pipeline.STAGES[1:4]:
        got = stage(spark, more, SF)
        assert got.columns == more.columns, name
        rows = {r.doc_id: r for r in got.collect()}
        assert all(r[c] == f"{c}{k}" for k, r in rows.items() for c in own), name
        plain = {r.doc_id: r.text for r in stage(spark, docs, SF).collect()}
        assert {k: r.text for k, r in rows.items()} == plain, name
    told = corpus_pipeline.by_language(spark, more, SF)
    assert told.columns == more.columns and all(r["_p"] == f"_p{r.doc_id}" for r in told.collect())


def test_of_rows_that_share_a_key_always_the_same_stays(spark):
    rows = [(1, f"text number {i} of the key, with words of its own {i * 7}", None if i % 2 else i) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = [simhash.keep_one(df.orderBy(F.rand(seed)).repartition(seed + 1)).collect() for seed in range(3)]
    assert len(kept[0]) == 1 and kept[0] == kept[1] == kept[2]
