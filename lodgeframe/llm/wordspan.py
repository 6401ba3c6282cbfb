"""Words of a batch of texts as arrays: boundaries from byte classes, hashes of words and shingles by prefix sums."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_PIECE = 1 << 20


@cache
def _both_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse for a piece; made where words are hashed only."""
    return _powers(int(_BASE), _PIECE + 256), _powers(_inverse(int(_BASE)), _PIECE + 256)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Lower-cased bytes of all texts, the word bounds in them, and each text's range of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # texts + 1 entries: words of text i are first[i]:first[i + 1]

    def text(self, a: int, b: int) -> str:
        """Words a..b-1 of one text, joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b])).decode("utf-8", "replace")

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, in pieces of about ``_PIECE`` bytes to bound the memory."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(out):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + _PIECE, side="right")))
            starts, ends = self.starts[at:to] - low, self.ends[at:to] - low
            n = int(ends[-1]) + 1
            forth, back = (p if len(p) >= n else _powers(int(p[1]), n) for p in _both_powers())
            sums = np.zeros(n, dtype=np.uint64)
            np.cumsum((self.data[low : low + n - 1].astype(np.uint64) + np.uint64(1)) * forth[: n - 1], out=sums[1:])
            out[at:to] = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
            at = to
        return out


def batches(texts: Iterable[str | None], limit: int = 1 << 20) -> Iterator[list[str | None]]:
    """Runs of texts of about ``limit`` characters together; a longer text is a run of its own."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text or "") > limit:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text or "")
    if group:
        yield group


def words_of(texts: list[str | None]) -> Words:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z were lower-cased; null has none."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)]
    edge = np.diff(np.concatenate(([False], _WORD[data])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    limits = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return Words(data, starts, ends, np.searchsorted(starts, limits))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` word hashes; runs over the end are left out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(out)
