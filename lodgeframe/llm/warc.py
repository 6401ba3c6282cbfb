"""WARC archives: records in key order, files rolled by compressed size, digests and headers made anew."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.shards import range_bounds, read_shards, shard_of, write_shards
from lodgeframe.session import checkpointed

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
SHARD_BYTES, ROLL_BYTES = 64 << 20, 8 << 20  # a shard of payload, compressed several roll sizes large


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(headers: list[tuple[str, object]], block: bytes, level: int) -> bytes:
    """One gzip member. Line ends in header values would forge headers, so they are percent-encoded."""
    lines = ["WARC/1.1"]
    for name, value in [*headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", len(block))]:
        if value is not None:
            lines.append(f"{name}: {str(value).replace(chr(13), '%0D').replace(chr(10), '%0A')}")
    data = "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    out = io.BytesIO()
    with gzip.GzipFile(filename="", mode="wb", fileobj=out, compresslevel=level, mtime=0) as member:
        member.write(data)
    return out.getvalue()


class WarcFile:
    """Adds page rows as response or revisit records; marker rows say which page a payload was seen on first."""

    def __init__(self, stream, shard: int, part: int, date: str = DATE, level: int = 6) -> None:
        self.stream, self.date, self.level = stream, date, level
        self.records = self.units = self._bytes = 0
        self.key, self.earlier, self.here = None, {}, set()
        self._write([("WARC-Type", "warcinfo"), ("WARC-Record-ID", self._id(f"file {shard} {part}")),
                     ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")

    @staticmethod
    def _id(name: str) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"

    def _write(self, headers: list, block: bytes) -> None:
        member = _record(headers, block, self.level)
        self.stream.write(member)
        self._bytes += len(member)

    def add(self, row) -> None:
        key = None if pd.isna(row.key) else int(row.key)
        if key != self.key:
            self.key, self.earlier, self.here = key, {}, set()
        if row.first_digest is not None:
            self.earlier[row.first_digest] = int(row.first)
            return
        payload = (row.payload or "").encode("utf-8", "surrogatepass")
        mark = digest(payload)
        first = self.earlier.get(hashlib.sha1(payload).hexdigest())
        if first is None and mark in self.here and key is not None and len(payload) >= row.least:
            first = key  # the same row again
        self.here.add(mark)
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        revisit = first is not None
        headers = [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", self._id(f"page {key} {mark} {self.records if key is None or revisit and first == key else ''}")),
            ("WARC-Date", self.date),
            ("WARC-Target-URI", row.url),
            ("WARC-Profile", PROFILE if revisit else None),
            ("WARC-Refers-To", self._id(f"page {first} {mark} ") if revisit else None),
            ("X-Page-Key", key),
            ("X-Refers-To-Page-Key", first),
            ("WARC-Payload-Digest", f"sha1:{mark}"),
            ("Content-Type", "application/http;msgtype=response"),
        ]
        self._write(headers, head if revisit else head + payload)
        self.records += 1
        self.units += len(payload)

    def size(self) -> int:
        return self._bytes

    def close(self) -> None:
        self.stream.close()


def write_warc(
    df: DataFrame,
    base: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Writes one record for each row below ``base``, in key order, and returns the manifest.

    Of equal payloads of at least ``least_bytes`` the one with the smallest key is a response, the others
    revisit it; of rows that repeat key and payload one is the response. Null payloads are empty; rows with
    a null key are responses, come first and are never referred to. Contents and file names depend on the
    rows alone. Payloads are shuffled once: which rows are revisits is found from digests, and comes to the
    writer as marker rows in the same key ranges.
    """
    full = df.select(
        F.col(key).cast("long").alias("key"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload")
    )
    marks = checkpointed(full.select("key", F.sha1("payload").alias("d"), F.octet_length("payload").cast("long").alias("n")))
    named = marks.where(F.col("key").isNotNull() & (F.col("n") >= least_bytes))
    # written, so that the join deals out both sides itself, and can split a hot payload
    counted = named.groupBy("d").agg(F.min("key").alias("first"), F.count("*").alias("c"))
    firsts = checkpointed(counted.where("c > 1").select("d", "first"))
    markers = named.select("key", "d").join(firsts, "d").where("key > first").distinct()
    rows = full.withColumns(
        {"first_digest": F.lit(None).cast("string"), "first": F.lit(None).cast("long"), "least": F.lit(least_bytes)}
    ).unionByName(
        markers.select("key", F.col("d").alias("first_digest"), "first"), allowMissingColumns=True
    )
    bounds = range_bounds(marks, "key", "n", shard_bytes)
    dealt = rows.withColumn("shard", shard_of(F.col("key"), bounds)).repartitionById(len(bounds) + 1, F.col("shard"))
    ordered = dealt.sortWithinPartitions("shard", "key", F.col("first_digest").isNull(), "url", F.xxhash64("payload"))
    return write_shards(ordered, base, ".warc.gz", WarcFile, roll_bytes)


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    left = b""
    while left or (left := stream.read(1 << 20)):
        member, out = zlib.decompressobj(31), []
        while not member.eof:
            if not left and not (left := stream.read(1 << 20)):
                raise EOFError("the last record is cut off")
            out.append(member.decompress(left))
            left = member.unused_data if member.eof else b""
        yield b"".join(out)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"digest of {fields['WARC-Record-ID']}")
    return fields, block


PAGES = "key long, url string, payload string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _pages(stream, _) -> Iterator[pd.DataFrame]:
    rows, held = [], 0
    names = [c.split()[0] for c in PAGES.split(", ")]
    for record in _members(stream):
        fields, block = parse(record)
        if fields["WARC-Type"] == "warcinfo":
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        declared = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
        mark = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        response = fields["WARC-Type"] == "response"
        if response and (digest(payload) != mark or len(payload) != declared):
            raise ValueError(f"payload of {fields['WARC-Record-ID']}")
        key, refers = fields.get("X-Page-Key"), fields.get("X-Refers-To-Page-Key")
        text = payload.decode("utf-8", "surrogatepass") if response else None
        rows.append((key and int(key), fields.get("WARC-Target-URI"), text, declared, mark, fields["WARC-Type"], refers and int(refers)))
        held += len(payload)
        if held > 4 << 20 or len(rows) >= 5000:
            yield pd.DataFrame(rows, columns=names).astype({"key": "Int64", "refers_to": "Int64"})
            rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=names).astype({"key": "Int64", "refers_to": "Int64"})


def read_warc(manifest: DataFrame, base: str) -> DataFrame:
    """All records of the listed files; digests and lengths are checked on the way."""
    return read_shards(manifest, base, _pages, PAGES, [])
