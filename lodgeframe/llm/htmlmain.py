"""HTML extraction: subtrees that recur over the pages of a host are template and go; the main text stays."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.htmltree import article_boxes, main_text, mark, parse
from lodgeframe.llm.url_filter import url_host
from lodgeframe.session import checkpointed, scratch_path


def subtree_hashes(page: Column) -> Column:
    """The hashes of all element subtrees with text, each once a page: ``hashes`` outside the main content; inside it
    ``boxes`` and ``brief`` with the ``article`` and its ``sketch``, as ``article_boxes`` gives them."""

    @F.pandas_udf("hashes array<long>, article long, sketch long, boxes array<long>, brief array<long>")
    def of(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for pages in series:
            rows = []
            for p in pages:
                root = parse(p or "")
                rows.append((mark(root), *article_boxes(root)))
            yield pd.DataFrame(rows, columns=["hashes", "article", "sketch", "boxes", "brief"])

    return of(page)


def site_templates(pages: DataFrame, least_pages: int = 5) -> DataFrame:
    """(site, hash): the subtrees on at least ``least_pages`` different pages of a site, however many it has.

    ``pages`` has site, page (a digest of its content) and hashes; copies of a page count once, so a page that is
    mirrored is no template of itself. Counts are combined before the shuffle: no site and no subtree is a hot task.
    """
    each = pages.dropDuplicates(["site", "page"]).select("site", F.explode("hashes").alias("hash"))
    return each.groupBy("site", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages).select("site", "hash")


NO_ARTICLE = 0  # the article's hash of a page without main content
ARTICLE = 0  # stands for the article itself among its boxes, so that one count gives articles and boxes


def article_templates(pages: DataFrame, least_articles: int = 20, least_sketches: float = 0.5) -> DataFrame:
    """(site, hash): the boxes inside main content that stand in many articles which have little else in common.

    ``pages`` has site, article, sketch, boxes and brief. Equal articles count once. Of the articles with a box
    there are ``least_articles`` at least, with as many as ``least_sketches`` times different sketches, so what near
    copies of an article share stays. A brief box, which prose may repeat, has to be in half of a site's articles
    as well.
    """
    found = pages.where(F.col("article") != NO_ARTICLE).dropDuplicates(["site", "article"])
    marked = F.concat(
        F.array(F.struct(F.lit(ARTICLE).cast("bigint").alias("hash"), F.lit(False).alias("brief"))),
        F.transform("boxes", lambda h: F.struct(h.alias("hash"), F.lit(False).alias("brief"))),
        F.transform("brief", lambda h: F.struct(h.alias("hash"), F.lit(True).alias("brief"))),
    )
    each = found.select("site", "sketch", F.inline(marked))
    counts = each.groupBy("site", "hash", "brief", "sketch").agg(F.count("*").alias("n"))
    counts = counts.groupBy("site", "hash", "brief").agg(F.sum("n").alias("n"), F.count("*").alias("sketches"))
    enough = (F.col("n") >= least_articles) & (F.col("sketches") >= F.col("n") * least_sketches)
    counts = checkpointed(counts.where(enough | (F.col("hash") == ARTICLE)))
    often = counts.where(enough & (F.col("hash") != ARTICLE))
    articles = counts.where(F.col("hash") == ARTICLE).select("site", F.col("n").alias("articles"))
    return often.join(articles, "site").where("NOT brief OR 2 * n >= articles").select("site", "hash")


def removed_subtrees(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """(site, page, removed): of every different page that has any, its own subtrees among the templates of its site.

    Of a page with main content only that counts, so what stands outside it need not be looked for. An array holds
    hashes of one page, so it does not grow with the site. Template rows are dealt out with the hash, and a hash that
    very many pages have is split by the join.
    """
    outside = F.when(F.col("article") == NO_ARTICLE, F.col("hashes")).otherwise(F.array().cast("array<bigint>"))
    own = F.explode(F.concat(outside, "boxes", "brief"))
    each = pages.dropDuplicates(["site", "page"]).select("site", "page", own.alias("hash"))
    return each.join(templates, ["site", "hash"]).groupBy("site", "page").agg(F.collect_set("hash").alias("removed"))


def extract(
    df: DataFrame,
    key: str = "page_id",
    url: str = "url",
    page: str = "html",
    least_pages: int = 5,
    least_articles: int = 20,
) -> DataFrame:
    """(key, url, text), one row for each row of ``df``.

    Per host, element subtrees are hashed and counted; those on ``least_pages`` different pages are deleted wherever
    they stand on its pages. The count is the same for hosts of any size. Inside an article or main element, where
    mirrors and quotations share paragraphs, only boxes go that stand in ``least_articles`` otherwise different
    articles (see ``article_templates``); paragraphs of prose without class, id and role always stay. Of what is left, the article (else main, else the whole page) gives
    the text, without elements that are page parts by their kind, role or class. Null pages have an empty text;
    pages without a host have no template. Repeated rows are extracted each. Other columns are not carried.
    Only pages with removed subtrees have to meet them: where those are many, pages are shuffled once, and adaptive
    execution splits many copies there.
    """
    host = url_host(F.coalesce("u", F.lit("")))
    rows = df.select(F.col(key).alias("k"), F.col(url).alias("u"), F.coalesce(F.col(page), F.lit("")).alias("p"))
    rows = rows.withColumns({"site": F.when(host != "", F.xxhash64(host)), "page": F.xxhash64("p")})
    named = rows.where("site IS NOT NULL").select("site", "page", subtree_hashes(F.col("p")).alias("h")).select("site", "page", "h.*")
    # written, so that pages are parsed once for all counts, and again only for their text
    named = checkpointed(named)
    # written, so that the joins deal out both sides themselves, and can split a hot subtree or page
    templates = checkpointed(site_templates(named, least_pages).unionByName(article_templates(named, least_articles)))
    # a written table has a known size: Spark sends it to all pages where it is small, else it shuffles both
    path = scratch_path(df.sparkSession, "removed")
    removed_subtrees(named, templates).withColumnsRenamed({"site": "s", "page": "d"}).write.parquet(path)
    joined = rows.join(df.sparkSession.read.parquet(path), (F.col("site") == F.col("s")) & (F.col("page") == F.col("d")), "left")

    @F.pandas_udf("string")
    def text(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for pages, removed in parts:
            out = []
            for p, hashes in zip(pages, removed):
                root = parse(p)
                if hashes is None:
                    out.append(main_text(root))
                    continue
                mark(root)
                out.append(main_text(root, frozenset(hashes.tolist())))
            yield pd.Series(out, dtype="object")

    return joined.select(F.col("k").alias(key), F.col("u").alias("url"), text("p", "removed").alias("text"))
