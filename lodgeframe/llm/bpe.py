"""Byte-level BPE: scanned pre-tokens, cached pair merging, decoding by offsets."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lodgeframe.llm.held import held
from lodgeframe.llm.pretoken import distinct_pretokens
from lodgeframe.llm.wordspan import batches

CACHE_ENTRIES = 400_000
_SHORT = 64  # bytes up to which rescanning all pairs beats a heap


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank in every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the adjacent pair of lowest rank is merged, leftmost first, until none is known."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    return _merge_long(piece, ranks) if len(piece) > _SHORT else _merge_short(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    cuts = list(range(len(piece) + 1))
    none = len(ranks) + len(piece)
    costs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while costs:
        best = min(costs)
        if best == none:
            break
        i = costs.index(best)
        del cuts[i + 1], costs[i]
        if i < len(costs):
            costs[i] = ranks.get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            costs[i - 1] = ranks.get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in pairwise(cuts)]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over linked parts, for pieces such as a page of dashes."""
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n

    def pair(i: int) -> tuple[int, int, int] | None:
        j = after[i]
        if j >= n:
            return None
        rank = ranks.get(piece[i : end[j]])
        return None if rank is None else (rank, i, end[j])

    heap = [p for p in map(pair, range(n - 1)) if p]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (i, before[i]):
            if k >= 0 and (p := pair(k)):
                heapq.heappush(heap, p)
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


class PieceCache:
    """Ids of the pre-tokens seen so far, in one flat array; new ones of a batch are encoded together.

    When more than ``most`` are held, those met once go, and then all but the half met most.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], most: int = CACHE_ENTRIES) -> None:
        self.encode, self.most = encode, most
        self._set([], np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))

    def _set(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray, hits: np.ndarray) -> None:
        self.places = dict(zip(pieces, range(len(pieces))))
        self.ids, self.sizes, self.hits = ids, sizes, hits

    def _shrink(self) -> None:
        kept = np.flatnonzero(self.hits > 1)
        if len(kept) > self.most // 2:
            kept = np.sort(kept[np.argsort(-self.hits[kept], kind="stable")[: self.most // 2]])
        wanted = np.zeros(len(self.sizes), dtype=bool)
        wanted[kept] = True
        pieces = [piece for piece, keep in zip(self.places, wanted.tolist()) if keep]
        self._set(pieces, self.ids[np.repeat(wanted, self.sizes)], self.sizes[kept], np.ones(len(kept), dtype=np.int64))

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of ids of each."""
        if len(self.places) > self.most:
            self._shrink()
        pieces, kinds, counts = distinct_pretokens(texts)
        place = np.fromiter(map(self.places.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        unseen = np.flatnonzero(place < 0).tolist()
        if unseen:
            new = list(dict.fromkeys([pieces[i] for i in unseen]))
            # taken one by one: lists of all new ones at once keep the garbage collector busy
            fresh, sizes = array("i"), array("q")
            for found in self.encode(new):
                fresh.extend(found)
                sizes.append(len(found))
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new))))
            self.ids = np.concatenate((self.ids, np.frombuffer(fresh, dtype=np.int32)))
            self.sizes = np.concatenate((self.sizes, np.frombuffer(sizes, dtype=np.int64)))
            self.hits = np.concatenate((self.hits, np.zeros(len(new), dtype=np.int64)))
            place[unseen] = [self.places[pieces[i]] for i in unseen]
        place = place[kinds]
        self.hits += np.bincount(place, minlength=len(self.hits))
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        first = (np.cumsum(self.sizes) - self.sizes)[place]
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(first - (ends - sizes), sizes) + np.arange(total)]
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        return ids, np.diff(bounds)


def cached(name: str, encode: Callable[[], Callable[[list[str]], Iterable[list[int]]]]) -> PieceCache:
    return held(name, lambda: PieceCache(encode()))


def _with(df: DataFrame, added: str) -> tuple[DataFrame, T.StructType]:
    """``df`` without columns of the added names, and its schema with them."""
    fields = T.StructType.fromDDL(added).fields
    kept = df.drop(*(f.name for f in fields))
    return kept, T.StructType([*kept.schema.fields, *fields])


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), values)


def _encoded(batch: pa.RecordBatch, text: str, cache: PieceCache, length: np.ndarray) -> Iterator[pa.RecordBatch]:
    at = 0
    for group in batches(t.as_py() for t in batch.column(text)):  # not the texts of a whole batch at once
        ids, counts = cache.encode_texts([t or "" for t in group])
        sizes = length[ids].astype(np.int64)
        ends = np.cumsum(sizes)
        before = np.concatenate(([0], ends))[np.cumsum(counts) - counts]
        ends = (ends - np.repeat(before, counts)).astype(np.int32)
        part = batch.slice(at, len(group))
        at += len(group)
        yield pa.RecordBatch.from_arrays(
            [*part.columns, _lists(ids, counts), _lists(ends, counts)], names=[*part.schema.names, "ids", "ends"]
        )


def _lengths(ranks: dict[bytes, int]) -> np.ndarray:
    length = np.zeros(max(ranks.values(), default=0) + 1, dtype=np.int32)
    length[list(ranks.values())] = [len(token) for token in ranks]
    return length


def _decoded(batch: pa.RecordBatch, flat: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    def lists(name: str) -> Iterator[np.ndarray | None]:
        column = batch.column(name)
        return (None if x is None else x.values.to_numpy() for x in column)

    out = [_bytes(i, e, flat, at) for i, e in zip(lists("ids"), lists("ends"))]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "bytes"])


def _places(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, and where each id's begin."""
    flat = np.frombuffer(b"".join(ranks), dtype=np.uint8)
    at = np.zeros(max(ranks.values(), default=0) + 1, dtype=np.int64)
    sizes = np.array([len(token) for token in ranks], dtype=np.int64)
    at[list(ranks.values())] = np.cumsum(sizes) - sizes
    return flat, at


def _bytes(ids: np.ndarray | None, ends: np.ndarray | None, flat: np.ndarray, at: np.ndarray) -> bytes | None:
    if ids is None or ends is None:
        return None
    if not len(ids):
        return b""
    sizes = np.diff(ends, prepend=0)
    return flat[np.repeat(at[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]))].tobytes()


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` of every whole text, and ``ends``, the byte offset at which each token ends.

    No special tokens are known: their strings are ordinary text. Null is encoded as the empty text. All
    rows and other columns stay; columns of the added names are replaced. The rank file is read once by the
    caller and broadcast; its size is that of the vocabulary.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept, schema = _with(df, "ids array<int>, ends array<int>")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, length = _merger(path, shared.value), _lengths(shared.value)
        for part in parts:
            yield from _encoded(part, text, cache, length)

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, path: str) -> DataFrame:
    """Adds ``bytes``: the tokens of ``ids``, each copied to the place that ``ends`` kept. Null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept, schema = _with(df, "bytes binary")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, at = _places(shared.value)
        for part in parts:
            yield _decoded(part, flat, at)

    return kept.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``decode(encode(df))`` in one pass of the workers, about a million characters at a time."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept, schema = _with(df, "ids array<int>, ends array<int>, bytes binary")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, length = _merger(path, shared.value), _lengths(shared.value)
        flat, at = _places(shared.value)
        for part in parts:
            for encoded in _encoded(part, text, cache, length):
                yield _decoded(encoded, flat, at)

    return kept.mapInArrow(run, schema)


def _merger(path: str, ranks: dict[bytes, int]) -> PieceCache:
    return cached(f"ranks {path}", lambda: lambda new: (merge(p.encode("utf-8", "surrogatepass"), ranks) for p in new))
