"""The registered query of every operator, with the SQL it must agree with where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm import (
    bpe,
    collocations,
    compression,
    decontaminate,
    exactdedup,
    htmlmain,
    language,
    negatives,
    pii,
    simhash,
    tokenfile,
    url_filter,
    warc,
)
from lodgeframe.session import scratch_path

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_compression_bands")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression.compression_bands(documents).select("doc_id", "quality.*")


URL_RULES = tuple(
    url_filter.Rule(host, path, verdict)
    for host, path, verdict in (
        ("com", "/", "allow"),
        ("example.com", "/en/", "block"),
        ("www.example.com", "/en/", "allow"),
        ("net", "/es/", "block"),
        ("net", "/fr/", "block"),
    )
)

#: Names of hosts whose pages make up the list of unwanted URLs.
UNWANTED_HOSTS = r"(^|\.)(spam-farm|cheap-pills|casino[a-z0-9-]*)\."

_OP3_PARTS = r"""
parts AS (
    SELECT page_id,
           CASE WHEN contains(coalesce(url, ''), '://')
                THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
           CASE WHEN contains(coalesce(url, ''), '://')
                THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM pages
),
named AS (
    SELECT *, CASE WHEN host <> '' THEN
        regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^(www|m)\.', '')
        || regexp_replace(regexp_replace(path, '/+$', ''), '(/index)?\.html?$', '') END AS name
    FROM parts
),
"""

OP3_SQL = f"""
WITH {_OP3_PARTS}
listed AS (
    SELECT DISTINCT name FROM named WHERE name IS NOT NULL AND regexp_matches(host, '{UNWANTED_HOSTS}')
),
rules(r_host, r_path, r_verdict) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
fits AS (
    SELECT page_id, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
           arg_max(r_verdict, length(r_host || r_path)) AS r_verdict
    FROM named JOIN rules
      ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    GROUP BY page_id
)
SELECT n.page_id, n.host, n.path, f.rule,
       f.rule IS NULL AND l.name IS NOT NULL AS listed,
       coalesce(f.r_verdict, CASE WHEN l.name IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM named n LEFT JOIN fits f USING (page_id) LEFT JOIN listed l ON n.name = l.name
"""


@query("op3_url_filter", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    unwanted = pages.where(url_filter.url_host(F.col("url")).rlike(UNWANTED_HOSTS))
    return url_filter.judge_urls(pages, unwanted, URL_RULES)


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_OP10_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP10_SQL = f"""
WITH items AS (SELECT item_id, {_OP10_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(list_slice(w, q, q + n - 1), ' ') AS words
    FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS q
          FROM items WHERE len(w) > 0)
),
docs AS (SELECT doc_id, {_OP10_WORDS} AS w FROM documents),
runs AS (
    SELECT doc_id, n, q, array_to_string(list_slice(w, q, q + n - 1), ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS q
          FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
found AS (SELECT r.doc_id, r.q, r.n, w.item_id FROM runs r JOIN windows w USING (n, words)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(q, q + n)) AS p FROM (SELECT DISTINCT doc_id, q, n FROM found))
    GROUP BY doc_id
),
listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(d.w), 0) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(l.n_items, 0) AS n_items, sha256(coalesce(l.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= coalesce(len(d.w), 0) AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN listed l USING (doc_id)
"""


@query("op10_decontaminate", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(documents, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def vocabulary(name: str) -> str:
    """The place of a file of the installed vocabulary package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.round_trip(documents, vocabulary("byte_bpe_multi_50k.tiktoken")).drop("text")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("bytes"), 256).alias("decoded_sha256"),
    )


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = language.fit(documents.where(~language.held_out(F.col("doc_id"))))
    found = documents.select("doc_id", language.language(spark, F.col("text"), samples).alias("p"))
    return found.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        F.col("p.lang").alias("lang_pred"),
        F.col("p.score").alias("score"),
    )


OP5_SQL = """
WITH marks AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS d,
           min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages
),
bits AS (
    SELECT *, array_to_string(list_transform(range(1, 41),
        lambda i: lpad(bin(strpos('0123456789abcdef', substr(d, i, 1)) - 1), 4, '0')), '') AS b
    FROM marks
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + list_sum(list_transform(range(1, 6), lambda k: CAST(substr(b, CAST(5 * i + k AS INTEGER), 1) AS INTEGER) << (5 - k)))::INTEGER, 1)), '')
           AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM bits
"""


@query("op5_warc", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "warc")
    manifest = warc.write_warc(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), base)
    return warc.read_warc(manifest, base).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op7_token_files")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "tokens")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = tokenfile.write_tokens(documents, base, vocabulary("byte_bpe_50k.json"))
    found = tokenfile.read_tokens(manifest, base, with_ids=False)
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op4_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.span_texts(pii.BASE), 256).alias("base_sha256"),
        pii.span_texts((*pii.BASE, pii.FOUND)).alias("spans"),
    )


@query("op6_html_main")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmlmain.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


OP13_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query("op13_exact_dedup", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.deduplicate(spark, f"{sf_dir}/documents.parquet")


OP12_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS id,
           CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
p AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER near AS INTEGER) AS rank, id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW near AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER near <= 5
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", "embedding", changed.alias("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, vector="embedding")


OP11_SQL = r"""
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
    FROM documents
),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM docs)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
    SELECT lang, m, w[i:i + m - 1] AS p
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, range(1, 6) t(m) WHERE len(w) >= m)
),
f AS (SELECT lang, m, p, count(*) AS f FROM grams GROUP BY lang, m, p HAVING count(*) >= 100),
cuts AS (SELECT lang, m, p, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (
    SELECT c.lang, c.m, c.p, c.a, c.k, x.f AS l, y.f AS r, n.n,
           CAST((1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:c.k] JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]
    JOIN n ON n.lang = c.lang
),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (
    SELECT lang, p[i:i + q - 1] AS p, max(f) AS f
    FROM (SELECT lang, p, f, q, unnest(range(1, m - q + 2)) AS i FROM f, range(2, 5) t(q) WHERE q < m) GROUP BY ALL
),
free AS (
    SELECT w.*, array_to_string(w.p, ' ') AS phrase
    FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.p = w.p WHERE i.f IS NULL OR 100 * i.f < 100 * w.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM free QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""


@query("op11_collocations", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))
