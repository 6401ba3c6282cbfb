"""Token-id files: patched frame-of-reference blocks with an index, written in key order and read back."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.bpe import cached
from lodgeframe.llm.shards import range_bounds, read_shards, shard_of, write_shards
from lodgeframe.llm.wordspan import batches
from lodgeframe.session import checkpointed

MAGIC = b"PFOR0002"
BLOCK = 1024
PERCENTILE = 90
SHARD_BYTES, ROLL_BYTES = 32 << 20, 256 << 20
_HEAD = struct.Struct("<IBH")  # of a block: minimum, width, number of exceptions
_TAIL = struct.Struct("<QQQQQ8s")  # where the keys begin, documents, those without a key, blocks, ids


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """Every ``BLOCK`` ids as bytes: minimum, width, exceptions, then the low bits of all ids less the minimum.

    The width is what the given share of a block fits in. Higher bits of the others stand in the exception
    list: their places (16 bits) and what is left of them above the width (32 bits).
    """
    out = []
    full = len(ids) // BLOCK
    for part in (ids[: full * BLOCK].reshape(full, BLOCK), ids[full * BLOCK :].reshape(1, -1)):
        if not part.size:
            continue
        rows, n = part.shape
        low = part.min(axis=1)
        deltas = (part - low[:, None]).astype(np.uint32)
        at = min(n - 1, -(-n * percentile // 100) - 1)
        common = np.partition(deltas, at, axis=1)[:, at]
        widths = np.ceil(np.log2(common.astype(np.float64) + 1)).astype(np.int64)
        packed: list[bytes] = [b""] * rows
        for width in np.unique(widths):
            of = np.flatnonzero(widths == width)
            for row, data in zip(of, _pack(deltas[of], int(width))):
                packed[row] = data.tobytes()
        high = deltas >> widths[:, None].astype(np.uint32)
        for row in range(rows):
            places = np.flatnonzero(high[row]).astype("<u2")
            head = _HEAD.pack(int(low[row]), int(widths[row]), len(places))
            out.append(head + places.tobytes() + high[row][places].astype("<u4").tobytes() + packed[row])
    return out


def _pack(deltas: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of every number, row by row, without gaps; the first number has the lowest bits.

    Up to 16 bits, eight numbers are put together in two words by shifts; the first ``width`` bytes are theirs.
    """
    rows, n = deltas.shape
    if width > 16:
        wide = np.unpackbits(deltas.astype("<u4").view(np.uint8), axis=1, bitorder="little")
        bits = wide.reshape(rows, n, -1)[:, :, :width].reshape(rows, -1)
        return np.packbits(bits, axis=1, bitorder="little")
    if width == 0:
        return np.zeros((rows, 0), dtype=np.uint8)
    low = np.zeros((rows, -(-n // 8) * 8), dtype=np.uint64)
    low[:, :n] = deltas & np.uint32((1 << width) - 1)
    pairs = low[:, 0::2] | low[:, 1::2] << np.uint64(width)
    fours = pairs[:, 0::2] | pairs[:, 1::2] << np.uint64(2 * width)
    first, second = fours[:, 0::2], fours[:, 1::2]
    words = np.empty((rows, first.shape[1], 2), dtype="<u8")
    if width == 16:
        words[:, :, 0], words[:, :, 1] = first, second
    else:
        words[:, :, 0] = first | second << np.uint64(4 * width)
        words[:, :, 1] = second >> np.uint64(64 - 4 * width)
    return words.view(np.uint8)[:, :, :width].reshape(rows, -1)[:, : (n * width + 7) // 8]


@cache
def _bit_places(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every number of a full block: the byte its bits begin in, and the place in that byte."""
    at = np.arange(BLOCK, dtype=np.int64) * width
    return at >> 3, (at & 7).astype(np.uint64)


def unpack_block(data: memoryview, n: int) -> np.ndarray:
    low, width, exceptions = _HEAD.unpack_from(data)
    at = _HEAD.size
    places = np.frombuffer(data, "<u2", exceptions, at)
    high = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    at += 6 * exceptions
    # the eight bytes from each byte on; a number of up to 32 bits lies in those from its first byte
    words = np.ndarray((len(data) - at + 1,), dtype="<u8", buffer=bytes(data[at:]) + bytes(8), strides=(1,))
    first, shift = _bit_places(width)
    out = (words[first[:n]] >> shift[:n] & np.uint64((1 << width) - 1)).astype(np.int64)
    out[places] += high.astype(np.int64) << width
    return out + low


class TokenFile:
    """MAGIC, the blocks, then: keys and lengths of the documents, block starts, and a tail that says where they are.

    Documents without a key come first; the tail says how many they are.
    """

    def __init__(self, stream, percentile: int = PERCENTILE) -> None:
        self.stream, self.percentile = stream, percentile
        self.records = self.units = self.unkeyed = 0
        self._held: list[np.ndarray] = []
        self._waiting = 0
        self._keys: list[int] = []
        self._lengths: list[int] = []
        self._starts: list[int] = []
        self._bytes = len(MAGIC)
        stream.write(MAGIC)

    def add(self, row) -> None:
        ids = row.ids
        if row.unkeyed and self.unkeyed < self.records:
            raise ValueError("documents without a key come first")
        self.unkeyed += bool(row.unkeyed)
        self._keys.append(int(row.key))
        self._lengths.append(len(ids))
        self.records += 1
        self.units += len(ids)
        self._held.append(ids)
        self._waiting += len(ids)
        if self._waiting >= 256 * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self._held) if self._held else np.zeros(0, dtype=np.int64)
        cut = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack_blocks(ids[:cut].astype(np.int64), self.percentile):
            self._starts.append(self._bytes)
            self.stream.write(block)
            self._bytes += len(block)
        self._held, self._waiting = [ids[cut:]], len(ids) - cut

    def size(self) -> int:
        return self._bytes

    def close(self) -> None:
        self._flush(True)
        tail = [np.array(x, dtype=kind).tobytes() for x, kind in ((self._keys, "<i8"), (self._lengths, "<u8"), (self._starts, "<u8"))]
        end = _TAIL.pack(self._bytes, self.records, self.unkeyed, len(self._starts), self.units, MAGIC)
        for data in (*tail, end):
            self.stream.write(data)
            self._bytes += len(data)
        self.stream.close()


def read_documents(stream) -> Iterator[tuple[int | None, np.ndarray]]:
    """(key, ids) of every document of a file in order, block by block from the index."""
    size = stream.size()
    stream.seek(size - _TAIL.size)
    at, documents, unkeyed, blocks, total, magic = _TAIL.unpack(stream.read(_TAIL.size))
    if magic != MAGIC:
        raise ValueError("not a token file")
    stream.seek(at)
    keys = np.frombuffer(stream.read(8 * documents), "<i8")
    lengths = np.frombuffer(stream.read(8 * documents), "<u8").astype(np.int64)
    starts = np.append(np.frombuffer(stream.read(8 * blocks), "<u8"), np.uint64(at)).astype(np.int64)
    held, ready, block = [], 0, 0
    for i, (key, length) in enumerate(zip(keys.tolist(), lengths.tolist())):
        while ready < length:
            stream.seek(int(starts[block]))
            data = memoryview(stream.read(int(starts[block + 1] - starts[block])))
            held.append(unpack_block(data, min(BLOCK, total - block * BLOCK)))
            ready += len(held[-1])
            block += 1
        ids = held[0] if len(held) == 1 else np.concatenate(held) if held else np.zeros(0, dtype=np.int64)
        held, ready = [ids[length:]], ready - length
        yield (None if i < unkeyed else key), ids[:length]


def library_encoder(path: str) -> Callable[[list[str]], Iterable[list[int]]]:
    """Ids of many pre-tokens by the model of the tokenizers library."""
    model, alphabet = _library(path)[0].model, _byte_letters()
    mark = "\U0010fffd"  # between pre-tokens, so that all are spelled in byte letters at once

    def letters(text: str) -> str:
        return text.encode("utf-8", "surrogatepass").decode("latin-1").translate(alphabet)

    def encode(pieces: list[str]) -> Iterable[list[int]]:
        spelled = letters(mark.join(pieces)).split(letters(mark))
        if len(spelled) != len(pieces):  # the mark is in a text
            spelled = [letters(piece) for piece in pieces]
        tokenize = model.tokenize
        return ([token.id for token in tokenize(word)] for word in spelled)

    return encode


def _byte_letters() -> dict[int, int]:
    """The printable letter that stands for each byte in byte-level vocabularies: its own, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


def frame_encoder(path: str, end_id: int) -> Callable[[pd.DataFrame], Iterator[pd.DataFrame]]:
    """Frames of about a million characters of ``text`` with ``ids``: those of the library, and ``end_id``.

    Pre-tokens are encoded by the library and remembered. Texts with the string of an added token are encoded
    by the library as they are.
    """

    def encode(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        whole, added = _library(path)
        known = cached(f"library {path}", lambda: library_encoder(path))
        at = 0
        for group in batches(frame["text"]):
            texts = [t or "" for t in group]
            plain = ["" if any(token in t for token in added) else t for t in texts]
            ids, counts = known.encode_texts(plain)
            parts = np.split(ids, np.cumsum(counts)[:-1])
            parts = [
                part if p is t else np.array(whole.encode(t, add_special_tokens=False).ids, dtype=np.int32)
                for part, p, t in zip(parts, plain, texts)
            ]
            ended = [np.append(part, np.int32(end_id)) for part in parts]
            yield frame[["shard", "key", "unkeyed"]].iloc[at : at + len(group)].assign(ids=pd.Series(ended, dtype="object", index=frame.index[at : at + len(group)]))
            at += len(group)

    return encode


@cache
def _library(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def write_tokens(
    df: DataFrame,
    base: str,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    percentile: int = PERCENTILE,
) -> DataFrame:
    """Writes the ids of every text below ``base`` in ascending key order and returns the manifest.

    ``path`` is the vocabulary of a byte-level tokenizer without normaliser and prefix space, installed on
    every worker. Null texts have the end id only; null keys come first; rows that repeat a key are written
    each, in the order of a hash of their text. An empty table gives one empty manifest.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    weights = checkpointed(rows.select("key", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n")))
    bounds = range_bounds(weights, "key", "n", shard_bytes)
    dealt = rows.withColumn("shard", shard_of(F.col("key"), bounds)).repartitionById(len(bounds) + 1, F.col("shard"))
    # a null among whole numbers would make them floating-point numbers on the way to Python
    keyed = dealt.select("shard", F.coalesce("key", F.lit(0)).alias("key"), F.col("key").isNull().alias("unkeyed"), "text")
    ordered = keyed.sortWithinPartitions("shard", F.desc("unkeyed"), "key", F.xxhash64("text"))
    return write_shards(
        ordered, base, ".pfor", lambda stream, shard, part: TokenFile(stream, percentile), roll_bytes, frame_encoder(path, end_id)
    )


def read_tokens(manifest: DataFrame, base: str, with_ids: bool = True) -> DataFrame:
    """(key, start, n_tokens, ids_crc32, ids) of every document of the listed files, the ids if they are wanted.

    ``start``: ids of all documents before it. The checksum is that of the ids as little-endian unsigned 32-bit integers.

    Only the manifest, a row for each file, is summed up in order.
    """
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base_ids", F.coalesce(F.sum("units").over(before), F.lit(0)))

    schema = "key long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    names = [column.split()[0] for column in schema.split(", ")]

    def load(stream, row) -> Iterator[pd.DataFrame]:
        rows, held, at = [], 0, int(row.base_ids)
        for key, ids in read_documents(stream):
            found = (key, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
            rows.append((*found, ids.astype(np.int32)) if with_ids else found)
            at += len(ids)
            held += len(ids)
            if held > 1 << 20:
                yield pd.DataFrame(rows, columns=names).astype({"key": "Int64"})
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names).astype({"key": "Int64"})

    return read_shards(placed, base, load, schema, ["base_ids"])
