"""Benchmark decontamination: a set join whose necessary prefix is the rarest shingle of every item window.

A window that occurs in a document has all of its shingles there, so one of them is enough to find it;
the rarest over all documents gives the fewest candidates. Candidates carry the words around them, are
bounded by length and position, and are verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.llm.wordspan import batches, shingle_hashes, words_of
from lodgeframe.session import checkpointed

WINDOW, SHINGLE, FILTER_BITS = 13, 4, 1 << 23


def item_windows(
    items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """(item_id, words, n, hashes): every window of an item, and the hashes of its shingles in order."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for group in batches(frame["text"]):
                found, rows = words_of(group), []
                hashed = found.hashes()
                for i, item in enumerate(frame["item_id"].iloc[: len(group)]):
                    a, b = int(found.first[i]), int(found.first[i + 1])
                    n = min(window, b - a)
                    for at in range(a, b - n + 1) if n else ():
                        shingles = shingle_hashes(hashed[at : at + n], min(shingle, n))
                        rows.append((item, found.text(at, at + n), n, shingles.view(np.int64).tolist()))
                frame = frame.iloc[len(group) :]
                yield pd.DataFrame(rows, columns=["item_id", "words", "n", "hashes"])

    kind = dict(items.dtypes)[key]
    named = items.select(F.col(key).alias("item_id"), F.col(text).alias("text"))
    return named.mapInPandas(cut, f"item_id {kind}, words string, n int, hashes array<long>")


def filter_of(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for every hash, as ``bits`` / 64 words whatever the number of hashes; only 64-bit words come here."""
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = hashes.select(
        F.shiftright(slot, 6).cast("int").alias("w"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int")).alias("b"),
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    for w, b in words.groupBy("w").agg(F.bit_or("b")).collect():
        out[w] = b
    return out.view(np.uint64)


def _passing(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Positions of the hashes whose bit is set."""
    slot = hashes & np.uint64(len(bits) * 64 - 1)
    return np.flatnonzero((bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1))


def _found(group: list[str | None], sizes: list[int], bits: np.ndarray):
    """The words of some texts, and (size, hashes, positions) of the shingles that pass the filter.

    Runs that span two texts are dropped.
    """
    found = words_of(group)
    hashed = found.hashes()
    out = []
    for size in sizes:
        shingles = shingle_hashes(hashed, size)
        at = _passing(shingles, bits)
        of = np.searchsorted(found.first, at, side="right") - 1
        inside = at + size <= found.first[of + 1] if len(at) else np.zeros(0, dtype=bool)
        out.append((size, shingles[at[inside]].view(np.int64), at[inside], of[inside]))
    return found, out


def shingle_counts(df: DataFrame, text: str, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """(hash, n): occurrences over all texts of the shingles that pass the filter."""
    shared = df.sparkSession.sparkContext.broadcast(bits)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for group in batches(frame["text"]):
                _, parts = _found(group, sizes, shared.value)
                for _, hashes, _, _ in parts:
                    values, n = np.unique(hashes, return_counts=True)
                    yield pd.DataFrame({"hash": values, "n": n})

    counted = df.select(F.col(text).alias("text")).mapInPandas(count, "hash long, n long")
    return counted.groupBy("hash").agg(F.sum("n").alias("n"))


def anchors(windows: DataFrame, counts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(hash, offset, n, words): each distinct window under its rarest shingle.

    A window with a shingle that no document has cannot occur, so it is left out.
    """
    distinct = windows.select("words", "n", "hashes").dropDuplicates(["words"])
    each = distinct.select("words", "n", F.posexplode("hashes").alias("offset", "hash"))
    rare = each.join(counts.withColumnRenamed("n", "seen"), "hash", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    best = rare.groupBy("words", "n").agg(F.min(F.struct("seen", "hash", "offset")).alias("a"))
    return best.where("a.seen > 0").select("a.hash", "a.offset", "n", "words")


def candidates(
    spark: SparkSession, text: str, sizes: list[int], bits: np.ndarray, window: int = WINDOW, shingle: int = SHINGLE
) -> Column:
    """A struct of every text: its words, and for each shingle that passes: hash, position, and the words around it."""
    shared = spark.sparkContext.broadcast(bits)

    @F.pandas_udf("n_words long, hash array<long>, pos array<int>, at array<int>, around array<string>")
    def probe(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            rows = []
            for group in batches(texts):
                found, parts = _found(group, sizes, shared.value)
                first = found.first
                mine = [([], [], [], []) for _ in group]
                for size, hashes, at, of in parts:
                    for h, p, i in zip(hashes.tolist(), at.tolist(), of.tolist()):
                        a, b = max(int(first[i]), p - window + size), min(int(first[i + 1]), p + window)
                        if size < shingle:  # the shingle is a whole window
                            a, b = p, p + size
                        for column, value in zip(mine[i], (h, p - int(first[i]), p - a, found.text(a, b))):
                            column.append(value)
                rows += [(int(n), *m) for n, m in zip(np.diff(first), mine)]
            yield pd.DataFrame(rows, columns=["n_words", "hash", "pos", "at", "around"])

    return probe(F.col(text))


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(key, row_hash, n_words, n_hit, items, contaminated), one row for each row of ``df``.

    ``row_hash`` is the hash of the text, which tells rows that repeat a key apart. A word is hit inside any occurrence of a window; contaminated: some are, and at least one in twenty.
    ``items``: sorted ids, as text, of the items with occurring windows. Null texts have no words; items
    without words have no windows; items without an id hit words but are not listed. Repeated rows are
    returned each. Other columns are not carried. Two passes over the texts, no text is shuffled.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k"), F.xxhash64(text).alias("r"), F.col(text).alias("text"))
    windows = checkpointed(item_windows(benchmark, item_key, item_text, window, shingle))
    sizes = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle)).alias("s")).distinct().collect())
    pieces = windows.select(F.explode("hashes").alias("hash"))
    counts = shingle_counts(rows, "text", sizes, filter_of(pieces, "hash", filter_bits))
    anchor = checkpointed(anchors(windows, counts, shingle))
    probe = candidates(spark, "text", sizes, filter_of(anchor, "hash", filter_bits), window, shingle)
    probed = checkpointed(rows.select("k", "r", probe.alias("c")).select("k", "r", "c.*"))
    near = probed.where(F.size("hash") > 0).select(
        "k", "r", "n_words", F.explode(F.arrays_zip("hash", "pos", "at", "around")).alias("c")
    ).select("k", "r", "n_words", "c.*")
    start = F.col("pos") - F.col("offset")
    inside = (start >= 0) & (F.col("at") >= F.col("offset")) & (start + F.col("n") <= F.col("n_words"))
    same = F.array_join(
        F.slice(F.split("around", " ", -1), F.col("at") - F.col("offset") + 1, F.col("n")), " "
    ) == F.col("words")
    hits = near.join(anchor.withColumnRenamed("hash", "h"), (F.col("hash") == F.col("h")) & F.when(inside, same))
    spans = checkpointed(hits.select("k", "r", start.alias("start"), "n", "words").distinct())
    members = windows.select("words", F.col("item_id").cast("string").alias("item")).where("item IS NOT NULL").distinct()
    named = (
        spans.select("k", "r", "words").distinct().join(members, "words").groupBy("k", "r")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    covered = F.flatten(F.transform(F.collect_set(F.struct("start", "n")), lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    words = spans.groupBy("k", "r").agg(F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    probed = probed.select("k", "r", "n_words")
    for part in (words, named):
        part = part.withColumnsRenamed({"k": "k2", "r": "r2"})
        probed = probed.join(part, F.col("k").eqNullSafe(F.col("k2")) & F.col("r").eqNullSafe(F.col("r2")), "left")
        probed = probed.drop("k2", "r2")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return probed.select(
        F.col("k").alias(key),
        F.col("r").alias("row_hash"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )
