"""Collocations: counts of the longest padded windows, summed up to all shorter phrases by one rollup."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.llm.wordspan import mix
from lodgeframe.operators.sizing import SALT, spread_join
from lodgeframe.session import checkpointed

UNDETERMINED = "und"
FILTER_BITS = 1 << 25  # 4 MB, whatever the corpus
LEVELS = 3  # words of the phrases that are counted for the filter
WIDE = "decimal(38,0)"
SALTS = 64  # tasks among which a language's candidates are ranked first
TASKS = 2  # tasks a core that count windows: each of them sends what it has of every frequent phrase
_GROUP, _HELD = 1 << 20, 1 << 20  # bytes of text at a time, words held before they are counted
_SENT = 1 << 20  # rows of counts held before they are summed up and, if that leaves many, sent on
_BATCH = 1 << 16  # rows sent at a time: strings are made for so many only
_OWN = 1 << 8  # words or rows that the objects of a language count as, for texts of very many languages
_MARK = b"."  # stands for all that ends a piece, so it is in no word
_FROM = b"".join(bytes([b]) for b in range(65, 91)) + b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_FROM, bytes(range(97, 123)) + _MARK * 10)
_GAP = -1  # the number of what ends a piece
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Vocabulary(dict):
    """Numbers of the words of a language in the order of their first use; ends of pieces are ``_GAP``."""

    def __init__(self) -> None:
        super().__init__({_MARK: _GAP})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 1
        return number

    def numbers(self, texts: list[bytes]) -> np.ndarray:
        """The numbers of all words of the texts, with a gap behind each piece and text."""
        words = b" . ".join(texts).translate(_TABLE).replace(_MARK, b" . ").split()
        out = np.empty(len(words) + 1, dtype=np.int64)
        out[:-1] = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        out[-1] = _GAP
        return out

    def words(self) -> list[bytes]:
        return list(self)[1:]


class Filter:
    """Hashes of phrases that occur often enough; a bit table, so others may pass, but none of them is missed.

    ``levels`` says up to which length phrases have been counted.
    """

    def __init__(self, bits: int) -> None:
        self.mask, self.levels = np.uint64(bits - 1), 0
        self.table = np.zeros(max(1, bits // 64), dtype=np.uint64)

    def add(self, places: np.ndarray, words: np.ndarray) -> None:
        """Bits of the next level."""
        self.table[places] |= words
        self.levels += 1

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _next(flags: np.ndarray, k: int = 1) -> np.ndarray:
    """What stands k places further on; nothing behind the end."""
    return np.pad(flags[k:], (0, min(k, len(flags))))


def _texts_by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Runs of texts of one language, of about ``_GROUP`` bytes together; a longer text is a run of its own."""
    texts = batch.column("text").cast(pa.large_binary())
    langs = batch.column("lang").to_pylist()
    held: dict[str, tuple[list[bytes], int]] = {}
    for lang, text in zip(langs, texts):
        body = text.as_py()
        run, size = held.get(lang, ([], 0))
        if run and size + len(body) > _GROUP:
            yield lang, run
            run, size = [], 0
        run.append(body)
        held[lang] = run, size + len(body)
    yield from ((lang, run) for lang, (run, _) in held.items())


class Tally:
    """Word numbers of texts of one language, held until they are counted, and the counts so far: numbers only."""

    def __init__(self, lang: str) -> None:
        self.lang, self.vocabulary = lang, Vocabulary()
        self.held: list[np.ndarray] = []
        self.size = 0
        self.taken: list[pa.RecordBatch] = []

    def add(self, texts: list[bytes]) -> None:
        self.held.append(self.vocabulary.numbers(texts))
        self.size += len(self.held[-1])

    def take(self) -> None:
        """Counts the words that are held, and lets go of them and of their vocabulary."""
        if self.held:
            ids, words = np.concatenate(self.held), self.vocabulary.words()
            self.held, self.size, self.vocabulary = [], 0, Vocabulary()
            self.taken.append(self._count(ids, words))

    def sum_up(self) -> None:
        """A row for each key that was counted."""
        if len(self.taken) > 1:
            table, self.taken = pa.Table.from_batches(self.taken), []
            keys = [name for name in table.column_names if name != "n"]
            summed = table.group_by(keys, use_threads=False).aggregate([("n", "sum")]).select([*keys, "n_sum"])
            self.taken = summed.rename_columns([*keys, "n"]).combine_chunks().to_batches()

    def rows(self) -> int:
        return sum(len(batch) + _OWN for batch in self.taken)

    def sent(self) -> Iterator[pa.RecordBatch]:
        """All counts, a row for each key; ``_BATCH`` rows at a time."""
        self.take()
        self.sum_up()
        taken, named = self.taken, self._naming()
        self.taken = []
        yield from (named(batch.slice(at, _BATCH)) for batch in taken for at in range(0, len(batch), _BATCH))

    def counts(self) -> pa.RecordBatch:
        return pa.concat_batches(list(self.sent()))

    def _count(self, ids: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
        """Keys, as numbers that hold until the counts are sent, and n."""
        raise NotImplementedError

    def _naming(self) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        """What makes counts as they are sent of those that are held."""
        return lambda counts: counts


class Places:
    """The words of a tally, with the phrases at each place that a filter lets through."""

    def __init__(self, ids: np.ndarray, words: list[bytes], lang: str, often: Filter) -> None:
        self.often = often
        seed = xxhash.xxh64_intdigest(lang.encode())
        digests = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))
        self.single = np.append(digests, np.uint64(0))[ids]  # the last one is the gap
        self.hashes, self.length = self.single, 1
        self.open = ids >= 0  # whether a phrase of ``length`` words starts here, whose parts are often enough
        self.passed: list[np.ndarray] = []

    def lengthen(self) -> None:
        """One word more."""
        ok = self.open.copy()
        ok[self.open] = self.often.has(self.hashes[self.open])
        self.passed.append(ok)
        self.open = ok & _next(ok)
        at = np.flatnonzero(self.open)
        longer = np.zeros_like(self.hashes)
        longer[at] = mix(self.hashes[at] * _STEP + self.single[at + self.length])
        self.hashes, self.length = longer, self.length + 1


class Grams(Tally):
    """Counts of the hashes of phrases of one word more than the filter knows, if their parts pass it."""

    def __init__(self, lang: str, often: Filter) -> None:
        super().__init__(lang)
        self.often = often

    def _count(self, ids: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
        places = Places(ids, words, self.lang, self.often)
        for _ in range(self.often.levels):
            places.lengthen()
        h, n = np.unique(places.hashes[places.open], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])


class Windows(Tally):
    """Counts of the padded windows that start at each word.

    A window ends with its piece, before ``order`` words are passed, or where a phrase in it is too rare: no phrase
    that is frequent enough reaches over that. Words that are too rare themselves are counted by one empty window.
    The words of windows keep their numbers until the counts are sent, so sums need no strings.
    """

    def __init__(self, lang: str, order: int, often: Filter) -> None:
        super().__init__(lang)
        self.order, self.often = order, often
        self.used = Vocabulary()

    def _lengths(self, ids: np.ndarray, words: list[bytes]) -> np.ndarray:
        """The words of the window that starts at each place; none at gaps and rare words."""
        places = Places(ids, words, self.lang, self.often)
        for _ in range(self.often.levels):
            places.lengthen()
        out, last = sum(ok.astype(np.int8) for ok in places.passed[: self.order]), places.passed[-1]
        goes_on = last
        for k in range(1, self.order - self.often.levels + 1):
            goes_on = goes_on & _next(last, k)
            out += goes_on
        return out

    def _count(self, ids: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
        lengths = self._lengths(ids, words)
        rare = np.count_nonzero((ids >= 0) & (lengths == 0))
        parts, counts = [np.full((1, self.order), _GAP)], [np.array([rare])]
        for length in range(1, self.order + 1):
            starts = np.flatnonzero(lengths == length)
            code = ids[starts]
            for k in range(1, length):  # numbered again with each word, so that keys stay short and counts exact
                _, code = np.unique(code * len(words) + ids[starts + k], return_inverse=True)
            _, first, n = np.unique(code, return_index=True, return_counts=True)
            window = np.full((len(n), self.order), _GAP)
            window[:, :length] = ids[starts[first][:, None] + np.arange(length)]
            parts.append(window)
            counts.append(n)
        table, n = np.concatenate(parts), np.concatenate(counts).astype(np.int64)
        own = np.full(len(words) + 1, _GAP, dtype=np.int32)  # the last one is the gap
        found = np.unique(table[table >= 0])
        own[found] = np.fromiter((self.used[words[i]] for i in found), dtype=np.int32, count=len(found))
        table = own[table]
        columns = [pa.array(table[:, k], mask=table[:, k] < 0) for k in range(self.order)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n)], [*(f"w{k + 1}" for k in range(self.order)), "n"])

    def _naming(self) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        texts = pa.array([w.decode("utf-8", "replace") for w in self.used.words()], pa.string())
        self.used = Vocabulary()
        names = ["lang", *(f"w{k + 1}" for k in range(self.order)), "n"]

        def named(counts: pa.RecordBatch) -> pa.RecordBatch:
            *words, n = counts.columns
            return pa.RecordBatch.from_arrays([pa.repeat(self.lang, len(n)), *(texts.take(w) for w in words), n], names)

        return named


def _tallies(make: Callable[[str], Tally]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The counts of a task by language, taken whenever its tallies hold ``_HELD`` words together.

    They are summed up before they are sent, so a task sends a phrase once; where it has more than ``_SENT`` / 2 of them,
    as often as its rows fill ``_SENT``.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        size = 0
        for batch in batches:
            for lang, texts in _texts_by_lang(batch):
                found = tallies.get(lang)
                if found is None:
                    found = tallies[lang] = make(lang)
                    size += _OWN
                before = found.size
                found.add(texts)
                size += found.size - before
                if size < _HELD:
                    continue
                for t in tallies.values():
                    t.take()
                size = 0
                if sum(t.rows() for t in tallies.values()) > _SENT:
                    for t in tallies.values():
                        t.sum_up()
                    if sum(t.rows() for t in tallies.values()) > _SENT // 2:
                        for t in tallies.values():
                            yield from t.sent()
                        tallies = {}
                    pa.default_memory_pool().release_unused()
        for t in tallies.values():
            yield from t.sent()

    return tally


def frequent_filter(texts: DataFrame, least: int, levels: int = LEVELS, bits: int = FILTER_BITS) -> Filter:
    """The phrases of up to ``levels`` words that occur ``least`` times in a language, as a bit table of a fixed size.

    A scan for each length; a phrase is counted only where both its parts of one word less passed before.
    """
    often = Filter(bits)
    for _ in range(levels):
        grams = texts.mapInArrow(_tallies(lambda lang: Grams(lang, often)), "h long, n long")
        counts = grams.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        place = F.shiftright(F.col("h").bitwiseAND(F.lit(bits - 1)), 6).alias("place")
        words = counts.groupBy(place).agg(F.bit_or(F.expr("shiftleft(1L, CAST(h & 63 AS INT))")).alias("word"))
        found = words.toArrow()  # bits / 64 rows at most
        often.add(found["place"].to_numpy(), found["word"].to_numpy().view(np.uint64))
    return often


def phrase_counts(texts: DataFrame, order: int, least: int, often: Filter) -> DataFrame:
    """(lang, m, words, n): how often every phrase of m words occurs, if ``least`` times at all; m = 0 counts all words.

    Only the longest padded window of each word is counted. A phrase is a prefix of the window at each of its
    places, so ROLLUP over the window's words gives the counts of all shorter phrases.
    """
    names = [f"w{k + 1}" for k in range(order)]
    schema = ", ".join(["lang string", *(f"{w} string" for w in names), "n long"])
    # each task sends every frequent phrase it has, so tasks must not grow in number with the corpus as phrases do
    dealt = texts.coalesce(TASKS * texts.sparkSession.sparkContext.defaultParallelism)
    windows = dealt.mapInArrow(_tallies(lambda lang: Windows(lang, order, often)), schema)
    counted = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    summed = counted.rollup("lang", *names).agg(F.grouping_id().alias("id"), F.sum("n").alias("n"))
    # a bit for each column that is summed over: the last words of the window
    length = F.lit(order) - F.bit_count("id").cast("int")
    phrases = summed.where("lang IS NOT NULL").select("lang", length.alias("m"), F.slice(F.array(*names), 1, length).alias("words"), "n")
    padded = (F.col("m") > 0) & F.get("words", F.col("m") - 1).isNull()
    return phrases.where(((F.col("m") == 0) | (F.col("n") >= least)) & ~padded)


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    order: int = 5,
    least: int = 100,
    covered: int = 100,
    top: int = 2000,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of 2 to ``order`` words of each language.

    A-Z are lower-cased; words are runs without blank and tab in pieces between ``.,;:!?`` and line ends. A phrase
    occurs a >= ``least`` times. Of its cuts into a first part (l times) and a rest (r times) the one with the smallest
    floor(1000 a n / (l r)) counts, n being all words of the language; ties go to the shorter first part. Phrases
    inside a longer one with ``covered`` percent of their count are left out. Ranked by score, a, and phrase (UTF-8).

    A null text has no words, a null language is ``und``. Repeated rows count each. Other columns are not read.
    Products are decimals of 38 digits. An empty table, or one without frequent phrases, gives an empty result. The
    memory of a task grows with its longest text only, also where nearly every row has a language of its own.
    """
    body, name = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED))
    texts = df.select(body.alias("text"), name.alias("lang"))
    counts = checkpointed(phrase_counts(texts, order, least, frequent_filter(texts, least, min(LEVELS, order), filter_bits)))
    phrases = counts.where("m > 0").select("lang", "m", "words", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"))
    # a phrase of one word more occurs as often as any longer one at least, so these decide for all
    shorter = F.array(*(F.array_join(F.slice("words", first, F.col("m") - 1), " ") for first in (1, 2)))
    inside = phrases.where("m > 2").select("lang", F.explode(shorter).alias("phrase"), F.col("a").alias("outer"))
    cover = inside.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    free = F.col("outer").isNull() | (F.col("outer").cast(WIDE) * 100 < F.col("a").cast(WIDE) * covered)
    kept = _with_cuts(phrases).join(cover, ["lang", "phrase"], "left").where(free)
    totals = counts.where("m = 0").select("lang", F.col("n").alias("total"))
    # a language may hold most phrases: it is dealt over SALTS tasks, and ranked in each of them first
    dealt = spread_join(kept, totals, ["lang"], ["phrase"], SALTS)
    return _ranked(dealt.withColumn("cut", _weakest()), top)


def _with_cuts(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more with ``cuts``: k, l and r of each way to cut them."""
    cuts = phrases.where("m > 1").select("lang", "phrase", "a", "words", "m", F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
    first, rest = F.slice("words", 1, F.col("k")), F.slice("words", F.col("k") + 1, F.col("m") - F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(first, " ").alias("first"), F.array_join(rest, " ").alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    counted = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    return counted.groupBy("lang", "phrase", "a").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts"))


def _weakest() -> Column:
    """(score, k, l, r) of the cut with the smallest score; whole numbers are divided, so it is exact."""
    score = f"(CAST(a AS {WIDE}) * total * 1000) div (CAST(c.l AS {WIDE}) * c.r)"
    return F.expr(f"array_min(transform(cuts, c -> named_struct('score', {score}, 'k', c.k, 'l', c.l, 'r', c.r)))")


def _ranked(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language. At most ``SALTS`` times as many of a language meet in one place."""
    order = (F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    local = F.row_number().over(Window.partitionBy("lang", SALT).orderBy(*order))
    best = phrases.withColumn("local", local).where(F.col("local") <= top)
    entry = F.struct((-F.col("cut.score")).alias("down"), (-F.col("a")).alias("less"), "phrase", "cut", "total")
    listed = best.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, top).alias("entries"))
    ranked = listed.select("lang", F.posexplode("entries").alias("place", "e"))
    return ranked.select(
        "lang",
        (F.col("place") + 1).cast("long").alias("rank"),
        "e.phrase",
        (-F.col("e.less")).alias("a"),
        F.col("e.cut.l").alias("l"),
        F.col("e.cut.r").alias("r"),
        F.col("e.total").alias("n"),
        F.col("e.cut.score").alias("score"),
    )
