"""Exact duplicates by a stream: keyed state on disk holds digest, identifier and locator, hits are checked byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeframe.session import checkpointed, scratch_path

#: Bits of the table of repeated digests, in bitmaps of 32 768: 1 MB however many digests there are.
MARK_BITS, BITMAP_BITS = 1 << 23, 1 << 15
PARTITIONS = "spark.sql.shuffle.partitions"
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # files take the space they need, not some megabytes each in advance
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _located(table: DataFrame, key: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    """(k, t, digest, at) of every row; ``at`` is its locator: the file and the number of the row in it."""
    body = F.coalesce(F.col(text), F.lit(""))
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return table.select(F.col(key).alias("k"), body.alias("t"), digest(body).alias("digest"), at.alias("at"))


def update_state(
    spark: SparkSession,
    path: str,
    state: str,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batches: int = 4,
) -> DataFrame:
    """Feeds the Parquet files of ``path`` that ``state`` has not seen through the stream; returns the state.

    (digest, n, keep): how many rows had the digest so far, and of the one that stays (the largest key, nulls
    last; of equal keys the last locator) its key and locator. The state lives in RocksDB below the shared
    folder ``state`` and never expires, so a later call goes on where this one, or a lost driver, stopped.
    The files come in ``batches`` parts of even number. Counts are combined before the shuffle, so a text that
    very many rows have is no hot task. None without any file.
    """
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    if not files:
        return None
    session = spark.newSession()
    for name, value in {**STATE, PARTITIONS: spark.conf.get(PARTITIONS)}.items():
        session.conf.set(name, value)
    reader = session.readStream.schema(table.schema).option("maxFilesPerTrigger", -(-files // batches))
    # as a pattern, so that a table of one file can be streamed as well
    rows = _located(reader.parquet(f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"), key, text, digest)
    held = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("k", "at")).alias("keep"))
    # noop: what counts is the state itself
    stream = held.writeStream.format("noop").outputMode("update").option("checkpointLocation", state)
    stream.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.format("statestore").load(state)
    return found.select("key.digest", F.col("value.count").alias("n"), F.col("value.max").alias("keep"))


def _bit(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(MARK_BITS))


def _marked(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows whose digest may be among the repeated ones; the others never meet a shuffle."""
    bit = _bit(F.col("digest"))
    marks = repeated.groupBy(F.floor(bit / BITMAP_BITS).alias("part")).agg(F.bitmap_construct_agg(bit % BITMAP_BITS).alias("bits"))
    asked = rows.withColumns({"part": F.floor(bit / BITMAP_BITS), "bit": (bit % BITMAP_BITS).cast("int")})
    byte = F.conv(F.hex(F.expr("substring(bits, bit div 8 + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("shiftleft(1, bit % 8)").bitwiseAND(byte) != 0
    # at most MARK_BITS / BITMAP_BITS rows of 4 KB
    return asked.join(F.broadcast(marks), "part").where(is_set).drop("part", "bit", "bits")


def deduplicate(
    spark: SparkSession,
    path: str,
    state: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batches: int = 4,
) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256), one row for each row of the Parquet table ``path``.

    Of rows with equal texts (null counts as empty) the one with the largest key stays; of rows that repeat
    a key and text one stays, and one of the rows without a key where no row of the group has one. A digest
    that comes again is a hit: the row's bytes are compared with those at the locator that the state holds. Should they
    differ, the rows of that digest are grouped by their whole texts instead. A ``state`` that has been used
    before belongs to the same table, which may have got more files since but lost none: only those are streamed,
    and all rows are judged anew. Extra columns are not read. An empty table gives an empty result.
    """
    table = spark.read.parquet(path)
    state = state or scratch_path(spark, "dedup-state")
    found = update_state(spark, path, state, key, text, digest, batches)
    if found is None:
        rows = table.select(F.col(key), F.col(key).alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
        return rows.withColumns({"kept": F.lit(True), "text_sha256": F.lit("")})
    written = f"{state}-{scratch_path(spark, 'groups').rsplit('/', 1)[1]}"
    found.write.parquet(written)
    groups = spark.read.parquet(written)
    rows = _located(table, key, text, digest)
    own = rows.select("k", "digest", "at", sha256(F.col("t")).alias("sha"))
    judged = own.join(groups, "digest").select("k", "sha", "at", "n", "keep")
    apart = _texts_apart(rows, groups)
    if apart is not None:
        other = apart.withColumnsRenamed({"at": "a", "n": "m", "keep": "other"})
        joined = judged.join(other, F.col("at") == F.col("a"), "left")
        judged = joined.select("k", "sha", "at", F.coalesce("m", "n").alias("n"), F.coalesce("other", "keep").alias("keep"))
    return judged.select(
        F.col("k").alias(key),
        F.col("keep.k").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("keep.at") == F.col("at")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _texts_apart(rows: DataFrame, groups: DataFrame) -> DataFrame | None:
    """(at, n, keep) of the rows whose digest stands for different texts, grouped by the texts; None without any.

    Only rows that may be hits carry their text into the shuffle. They are written, so that the comparison deals
    both its sides out itself and a text that very many rows have is split there.
    """
    repeated = groups.where("n > 1").select("digest", F.col("keep.at").alias("holder"))
    hits = checkpointed(_marked(rows, repeated).join(repeated, "digest"))
    held = hits.where(F.col("at") == F.col("holder")).select("digest", F.col("t").alias("bytes"))
    # nothing is grouped by the digest on top of the join, or it could not split a hot one
    differing = checkpointed(hits.join(held, "digest").where(F.col("t") != F.col("bytes")).select("digest"))
    if differing.isEmpty():
        return None
    rest = checkpointed(hits.join(differing.distinct(), "digest").select("k", "t", "at"))
    texts = rest.groupBy("t").agg(F.count("*").alias("n"), F.max(F.struct("k", "at")).alias("keep"))
    return rest.join(texts, "t").select("at", "n", "keep")
