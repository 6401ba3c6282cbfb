"""URL filters: host and path rules, then a blocked Bloom filter in front of an exact join with listed URLs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.session import checkpointed

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORDS = 4  # 64-bit words of a block
BITS = 6  # bits set for each URL, in one block


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains where the path starts with its path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; empty without ``://``."""
    start = F.locate("://", url)
    rest = F.substring(url, start + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(start > 0, host).otherwise(F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    start = F.locate("://", url)
    rest = F.substring(url, start + 3, F.length(url))
    return F.when(start > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as its text, else null."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.lit(r.text),
        )
        for r in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    return F.coalesce(*fits, F.lit(None).cast("string")) if fits else F.lit(None).cast("string")


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.``, path without index page, ``.html`` and trailing slash; the rest is dropped.

    Scheme, port 80 and 443, query and fragment do not tell pages apart here. Null where there is no host.
    """
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":(80|443)$", ""), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"/+$", ""), r"(/index)?\.html?$", "")
    return F.when(host != "", F.concat(host, path))


def _place(url: Column, blocks: int) -> list[Column]:
    """The block of a URL, and for each word of that block the bits the URL sets there."""
    bits = F.xxhash64(url, F.lit("bits"))
    drawn = [F.shiftrightunsigned(bits, 8 * k) for k in range(BITS)]
    masks = []
    for word in range(WORDS):
        ones = [
            F.when(
                d.bitwiseAND(F.lit(WORDS - 1)) == word,
                F.call_function(
                    "shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(d, 2).bitwiseAND(F.lit(63)).cast("int")
                ),
            ).otherwise(F.lit(0).cast("bigint"))
            for d in drawn
        ]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), ones))
    return [F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int"), *masks]


def bloom_blocks(urls: DataFrame, url: str, blocks: int) -> DataFrame:
    """The filter: (_block, _w0.._w3), at most ``blocks`` rows of 36 bytes, however long the list is."""
    block, *masks = _place(F.col(url), blocks)
    placed = urls.select(block.alias("_block"), *(m.alias(f"_w{i}") for i, m in enumerate(masks)))
    return placed.groupBy("_block").agg(*(F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)))


def bloom_hit(value: Column, blocks: int) -> tuple[Column, Column]:
    """The block to join the filter on, and whether the joined block has all bits of the value."""
    block, *masks = _place(value, blocks)
    return block, reduce(lambda a, b: a & b, (F.col(f"_w{i}").bitwiseAND(m) == m for i, m in enumerate(masks)))


def judge_urls(
    df: DataFrame,
    listed: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    listed_url: str = "url",
    blocks: int = 1 << 16,
) -> DataFrame:
    """(key, host, path, rule, listed, verdict), one row for each row of ``df``.

    A fitting rule decides. Else the URL is blocked if its canonical form is the canonical form of a listed
    URL: the Bloom filter (at most ``blocks`` * 36 bytes, so broadcast) lets misses pass without a shuffle,
    possible hits are joined exactly. A longer list only raises the share of possible hits.
    Null and malformed URLs, an empty list: nothing is listed, so ``allow``. Repeated rows are judged each;
    other columns of ``df`` are not carried.
    """
    # written, so that the exact join deals out both sides itself, and can split a hot URL
    wanted = checkpointed(listed.select(canonical(F.col(listed_url)).alias("_name")).where("_name IS NOT NULL").distinct())
    bloom = F.broadcast(bloom_blocks(wanted, "_name", blocks))
    host, path = url_host(F.coalesce(F.col(url), F.lit(""))), url_path(F.coalesce(F.col(url), F.lit("")))
    parts = df.select(F.col(key), host.alias("host"), path.alias("path"), canonical(F.col(url)).alias("_name"))
    ruled = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    block, hit = bloom_hit(F.col("_name"), blocks)
    probed = ruled.withColumn("_block", F.when(F.col("rule").isNull() & F.col("_name").isNotNull(), block))
    marked = probed.join(bloom, "_block", "left").withColumn("_maybe", F.coalesce(hit, F.lit(False)))
    kept = [key, "host", "path", "rule"]
    misses = marked.where(~F.col("_maybe")).select(*kept, F.lit(False).alias("listed"))
    exact = wanted.withColumn("_there", F.lit(True))
    hits = (
        marked.where("_maybe")
        .select(*kept, "_name")
        .join(exact, "_name", "left")
        .select(*kept, F.coalesce("_there", F.lit(False)).alias("listed"))
    )
    of_rule = F.create_map(*(F.lit(x) for r in rules for x in (r.text, r.verdict))) if rules else None
    verdict = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    if of_rule is not None:
        verdict = F.coalesce(of_rule[F.col("rule")], verdict)
    return misses.unionByName(hits).withColumn("verdict", verdict)
