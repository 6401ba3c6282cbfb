"""Deterministic sharded files: key ranges, temporary names, a manifest, and the commit that renames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANIFEST = "shard int, part int, temp string, name string, records long, units long, bytes long"
SAMPLED_KEYS = 40  # for each shard


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder as Spark names it, and its path there."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def range_bounds(df: DataFrame, key: str, weight: str, shard_weight: int) -> np.ndarray:
    """Lower ends of all shards but the first, such that shards weigh about ``shard_weight``.

    The keys are sampled by their hash, so bounds depend on the rows alone, not on partitions or runs:
    about ``SAMPLED_KEYS`` keys a shard come to the driver, a few in ten thousand rows.
    """
    rows, total = df.agg(F.count(key), F.sum(weight)).first()
    shards = max(1, -(-int(total or 0) // shard_weight))
    if shards == 1 or not rows:
        return np.zeros(0, dtype=np.int64)
    step = max(1, rows // (shards * SAMPLED_KEYS))
    sampled = df.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(step)) == 0))
    found = sampled.groupBy(key).agg(F.sum(weight).alias("w")).toPandas().sort_values(key)
    place = np.cumsum(found["w"].to_numpy(dtype=np.float64))
    marks = np.arange(1, shards) * (place[-1] / shards) if len(place) else np.zeros(0)
    at = np.minimum(np.searchsorted(place, marks, side="left") + 1, len(place) - 1)
    return np.unique(found[key].to_numpy(dtype=np.int64)[at])


def shard_of(key: Column, bounds: np.ndarray) -> Column:
    """The number of the shard of a key; null keys come first."""

    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        known = keys.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64)
        return pd.Series(np.searchsorted(bounds, known, side="right").astype(np.int32))

    return of(F.coalesce(key, F.lit(np.iinfo(np.int64).min)))


class Writer(Protocol):
    """Writes one file. ``size`` is what has been written so far, ``units`` what its manifest line counts."""

    records: int
    units: int

    def add(self, row) -> None: ...
    def size(self) -> int: ...
    def close(self) -> None: ...


def write_shards(
    df: DataFrame,
    base: str,
    suffix: str,
    open_writer: Callable[[object, int, int], Writer],
    roll_bytes: int,
    prepare: Callable[[pd.DataFrame], Iterator[pd.DataFrame]] | None = None,
) -> DataFrame:
    """Writes the rows of each ``shard`` in the order they have in their partition, and commits.

    Every task writes under names of its own; a row for each finished file goes into a Parquet manifest,
    whose commit decides which attempt counts. Then the listed files get their final names; renaming again
    after a lost executor does nothing. Files of attempts that did not count go with the temporary folder.
    ``prepare`` may turn a frame of rows into smaller ones with what the writer needs. Returns the manifest.
    """

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(base)
        fs.create_dir(f"{root}/_tmp", recursive=True)
        attempt, done, writer, at = uuid.uuid4().hex, [], None, (-1, 0)

        def finish() -> None:
            writer.close()
            temp = f"_tmp/{at[0]:06d}-{at[1]:05d}-{attempt}"
            done.append((*at, temp, f"part-{at[0]:06d}-{at[1]:05d}{suffix}", writer.records, writer.units, writer.size()))

        for frame in frames if prepare is None else (part for frame in frames for part in prepare(frame)):
            for row in frame.itertuples(index=False):
                if writer is not None and (row.shard != at[0] or writer.size() >= roll_bytes):
                    finish()
                    at, writer = (at[0], at[1] + 1), None
                if writer is None:
                    at = at if row.shard == at[0] else (row.shard, 0)
                    stream = fs.open_output_stream(f"{root}/_tmp/{at[0]:06d}-{at[1]:05d}-{attempt}", compression=None)
                    writer = open_writer(stream, *at)
                writer.add(row)
            if done:
                yield pd.DataFrame(done, columns=[c.split()[0] for c in MANIFEST.split(", ")])
                done = []
        if writer is not None:
            finish()
            yield pd.DataFrame(done, columns=[c.split()[0] for c in MANIFEST.split(", ")])

    def rename(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(base)
        for frame in frames:
            for temp, name in zip(frame["temp"], frame["name"]):
                if fs.get_file_info(f"{root}/{temp}").type != pafs.FileType.NotFound:
                    fs.move(f"{root}/{temp}", f"{root}/{name}")
                elif fs.get_file_info(f"{root}/{name}").type == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{base}/{name}")
            yield frame[["name"]]

    spark = df.sparkSession
    df.mapInPandas(write, MANIFEST).write.parquet(f"{base}/_manifest")
    manifest = spark.read.parquet(f"{base}/_manifest")
    manifest.mapInPandas(rename, "name string").count()
    fs, root = open_fs(base)
    if fs.get_file_info(f"{root}/_tmp").type != pafs.FileType.NotFound:
        fs.delete_dir(f"{root}/_tmp")
    return manifest


def read_shards(manifest: DataFrame, base: str, read: Callable, schema: str, columns: list[str]) -> DataFrame:
    """``read(stream, row)`` over every committed file, one task for each file; it yields frames of ``schema``."""
    files = max(1, manifest.count())

    def load(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = open_fs(base)
        for frame in frames:
            for row in frame.itertuples(index=False):
                with fs.open_input_file(f"{root}/{row.name}") as stream:
                    yield from read(stream, row)

    return manifest.select("name", *columns).repartition(files, "name").mapInPandas(load, schema)
