"""Review-like texts: documents, conversations, pages and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.functions import text as X
from lodgeframe.operators import aggregates as A
from lodgeframe.operators import lookups as L
from lodgeframe.operators import tables as O
from lodgeframe.queries.registry import Tables, query

CLEAN_SQL = (
    "trim(regexp_replace(regexp_replace(lower({c}), '<[^>]+>', ' ', 'g'), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"
)


@query("clean_text", f"SELECT doc_id, {CLEAN_SQL.format(c='text')} AS cleaned FROM documents")
def clean_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@query("clean_html", f"SELECT page_id, {CLEAN_SQL.format(c='html')} AS cleaned FROM pages")
def clean_html(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.clean_text(F.col("html")).alias("cleaned"))


@query(
    "text_length",
    "SELECT conv_id, turn, coalesce(length(CASE WHEN conv_id % 7 <> 0 THEN text END), 0)::INT AS n FROM conversations",
)
def text_length(t: Tables) -> DataFrame:
    text = F.when(F.col("conv_id") % 7 != 0, F.col("text"))
    return t.conversations.select("conv_id", "turn", X.text_length(text).alias("n"))


@query("lower_text", "SELECT item_id, lower(text) AS lowered FROM benchmark")
def lower_text(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", X.lower_text(F.col("text")).alias("lowered"))


def words_sql(table: str, text: str, top: int, stopwords: tuple[str, ...] = X.REVIEW_STOPWORDS) -> str:
    listed = ", ".join(f"'{w}'" for w in stopwords)
    return f"""w AS (SELECT unnest(regexp_split_to_array(regexp_replace(lower({text}), '[^a-z\\s\\p{{Z}}]', '', 'g'), '[\\s\\p{{Z}}]+')) AS word FROM {table})
    SELECT word, count(*) AS n FROM w WHERE length(word) > 2 AND word NOT IN ({listed}) GROUP BY word ORDER BY n DESC, word LIMIT {top}"""


@query("word_freq", "WITH " + words_sql("documents", "text", 20))
def word_freq(t: Tables) -> DataFrame:
    return A.word_freq(t.documents, "text", top=20)


# The longer English stopword list of the exploratory word count.
ENGLISH_STOPWORDS = (
    "the", "a", "an", "and", "or", "but", "if", "because", "as", "until", "while", "of", "at",
    "by", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just",
    "don", "should", "now", "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "your", "yours", "he", "him", "his", "she", "her", "it", "its", "they", "them", "their",
    "was", "were", "be", "is", "are", "am", "been", "being", "have", "has", "had", "do", "does",
    "did", "would",
)


@query("word_freq_english", "WITH " + words_sql("conversations", "text", 20, ENGLISH_STOPWORDS))
def word_freq_english(t: Tables) -> DataFrame:
    return A.word_freq(t.conversations, "text", 20, ENGLISH_STOPWORDS)


@query(
    "semi_join",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def semi_join(t: Tables) -> DataFrame:
    good = t.labels.where("quality = 1")
    return L.semi_join(t.documents.select("doc_id", "lang", "source"), good, "doc_id")


@query(
    "anti_join_diff",
    """SELECT doc_id, 'left' AS side FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents EXCEPT SELECT CAST(doc_id * 2 AS VARCHAR) FROM labels)
    UNION ALL SELECT doc_id, 'right' FROM (SELECT CAST(doc_id * 2 AS VARCHAR) AS doc_id FROM labels EXCEPT SELECT CAST(doc_id AS VARCHAR) FROM documents)""",
)
def anti_join_diff(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), (F.col("doc_id") * 2).cast("string"), F.lit(" "))
    return L.key_differences(t.documents, t.labels.select(padded.alias("doc_id")), "doc_id")


@query(
    "set_difference",
    """SELECT lang, source FROM documents EXCEPT
    SELECT lang, source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1""",
)
def set_difference(t: Tables) -> DataFrame:
    toxic = t.documents.join(t.labels.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    return L.set_difference(t.documents.select("lang", "source"), toxic.select("lang", "source"))


@query("dedup_exact", "SELECT DISTINCT text, lang FROM documents")
def dedup_exact(t: Tables) -> DataFrame:
    return O.dedup_exact(t.documents.select("text", "lang"))


@query(
    "dedup_key",
    """SELECT doc_id, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) AS r
    FROM documents) WHERE r = 1""",
)
def dedup_key(t: Tables) -> DataFrame:
    df = t.documents.select("doc_id", "lang", "source", "n_chars", (-F.col("n_chars")).alias("shortest_last"))
    return O.dedup_key(df, ["source", "lang"], ["shortest_last", "doc_id"]).drop("shortest_last")


@query(
    "duplicate_count",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct, CAST(sum(n - 1) AS BIGINT) AS n_duplicates
    FROM (SELECT count(*) AS n FROM documents GROUP BY text)""",
)
def duplicate_count(t: Tables) -> DataFrame:
    return O.duplicate_count(t.documents, ["text"])


@query(
    "label_t_test",
    """WITH j AS (SELECT CAST(n_chars AS DOUBLE) AS x, quality = 1 AS g FROM documents JOIN labels USING (doc_id)),
    a AS (SELECT count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n0, avg(x) FILTER (g) AS m1, avg(x) FILTER (NOT g) AS m0,
      var_samp(x) FILTER (g) AS v1, var_samp(x) FILTER (NOT g) AS v0 FROM j)
    SELECT n1, n0, n1 + n0 - 2 AS df, round((m1 - m0) / sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / (n1 + n0 - 2)
      * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n0)), 6) AS t FROM a""",
)
def label_t_test(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    table = A.two_sample_t(joined, F.col("quality") == 1, F.col("n_chars"))
    return table.select("n1", "n0", "df", F.round("t", 6).alias("t"))
