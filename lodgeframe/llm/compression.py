"""Quality rules: base counts of a text, then compression bands over the whole text and its fixed chunks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The characters that count as symbols, and the white space that separates words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_bytes long, ratio double, n_chunks long, low_chunks long, high_chunks long, kept boolean"
)


@dataclass(frozen=True)
class Band:
    """Allowed compressed share of texts of at least ``from_bytes`` bytes.

    Short texts do not repeat themselves enough to compress and pay the frame header, so both limits
    fall as the length grows.
    """

    from_bytes: int
    low: float
    high: float


#: A text is repetitive below ``low`` and incompressible above ``high``; below 200 bytes the frame decides, not the text.
WHOLE = (Band(200, 0.25, 0.95), Band(800, 0.22, 0.85), Band(3200, 0.20, 0.75), Band(12800, 0.18, 0.72))
#: The same for one chunk of ``chunk_bytes``.
CHUNK = Band(0, 0.15, 0.80)


def band_of(n_bytes: int, bands: tuple[Band, ...]) -> Band | None:
    """The band with the largest lower end that the length reaches."""
    return max((b for b in bands if b.from_bytes <= n_bytes), key=lambda b: b.from_bytes, default=None)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """words, their code points, symbols, repeated lines, words in repeated 3-word windows."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    lines: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            dup_lines += line in lines
            lines.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeat_words = 0
    if len(set(windows)) < len(windows):
        found, covered = Counter(windows), 0  # covered: end of the last repeated window
        for i, window in enumerate(windows):
            if found[window] > 1:
                repeat_words += i + 3 - max(i, covered)
                covered = i + 3
    blanks = sum(text.count(c) for c in BLANKS)
    return n, len(text) - blanks, sum(text.count(c) for c in SYMBOLS), dup_lines, repeat_words


def measure(
    text: str | None,
    compressor: zstandard.ZstdCompressor,
    whole: tuple[Band, ...] = WHOLE,
    chunk: Band = CHUNK,
    chunk_bytes: int = 4096,
    bad_share: float = 0.25,
) -> tuple:
    """One row of ``MEASURES``.

    The text fails if its own ratio leaves the band of its length, or if more than ``bad_share`` of its bytes
    are in chunks that leave theirs. The last chunk ends with the text: it is of full size and overlaps the one
    before, but stands for the bytes after that one only. Texts below ``chunk_bytes`` have no chunk, as the band
    of their length covers all of them. A null text is an empty one.
    """
    text = text or ""
    n_words, word_chars, n_symbols, n_dup, n_repeat = base_counts(text)
    failed = n_words < 50 or 100 * n_repeat > 50 * n_words
    data = text.encode("utf-8", "surrogatepass")
    size = len(data)
    ratio = len(compressor.compress(data)) / size if size else None
    chunks = -(-size // chunk_bytes) if size >= chunk_bytes else 0
    low = high = bad_bytes = 0
    for i in range(chunks):
        end = min((i + 1) * chunk_bytes, size)
        share = len(compressor.compress(data[end - chunk_bytes : end])) / chunk_bytes
        low += share < chunk.low
        high += share > chunk.high
        bad_bytes += (end - i * chunk_bytes) * (not chunk.low <= share <= chunk.high)
    band = band_of(size, whole)
    fits = band is None or band.low <= ratio <= band.high
    kept = not failed and fits and bad_bytes <= bad_share * size
    return n_words, word_chars, n_symbols, n_dup, n_repeat, failed, size, ratio, chunks, low, high, kept


def compression_bands(
    df: DataFrame,
    text: str = "text",
    out: str = "quality",
    level: int = 3,
    whole: tuple[Band, ...] = WHOLE,
    chunk: Band = CHUNK,
    chunk_bytes: int = 4096,
    bad_share: float = 0.25,
) -> DataFrame:
    """Adds the struct column ``out`` with ``MEASURES`` to every row; all rows and other columns stay.

    Null text: measured as empty, so it fails. Empty table: empty result. Equal rows get equal measures.
    A column already named ``out`` is replaced.
    """
    names = [part.split()[0] for part in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressor = zstandard.ZstdCompressor(level=level)
        for batch in batches:
            rows = [measure(t, compressor, whole, chunk, chunk_bytes, bad_share) for t in batch]
            yield pd.DataFrame(rows, columns=names).astype({"ratio": "float64"})

    return df.withColumn(out, judge(F.col(text)))
