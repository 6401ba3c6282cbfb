"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


PARTITION_BYTES = 200 * 1024**2


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions for a shuffle of that size: about 200 MB each, 200 at least.

    Adaptive execution merges the surplus of smaller shuffles but never adds partitions, so the
    number should fit the largest shuffle of a job.
    """
    return max(200, -(-shuffled_bytes // PARTITION_BYTES))


def build_session(
    app: str = "lodgeframe",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution on and UTC days.

    ``shuffled_bytes`` is the expected size of the largest shuffle; without it the partition
    count stays as the cluster (or ``conf``) sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffled_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffled_bytes))
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without any such folder gets one of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lodgeframe-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage, so that later branches read the same rows."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
