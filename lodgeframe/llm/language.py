"""Language identification by cross-parsing: how few longest matches in a language's sample make up a text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgeframe.llm.held import held
from lodgeframe.llm.pretoken import LETTER, code_point_classes
from lodgeframe.llm.wordspan import batches

UNDETERMINED = "und"
GAP, UNKNOWN, PAD, LETTERS = 0, 1, 2, 3  # symbols; letters of the samples follow
DENSE = 64  # symbols of a language, its most frequent letters, whose transitions are looked up without a search
LANE = 256  # symbols parsed in step; phrases run on from lane to lane


@dataclass(frozen=True)
class Samples:
    """The labelled text of each language, at most ``sample_chars`` characters each."""

    texts: tuple[tuple[str, str], ...]


def fit(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = 32,
    sample_chars: int = 32_768,
) -> Samples:
    """A bounded sample for each label: the ``sample_docs`` documents whose keys hash lowest, each giving at
    most an eighth of ``sample_chars``. Which rows are taken depends on keys only, not on partitions.

    Only keys and labels are ranked (with a limit before the shuffle), then the texts of the chosen are read.
    Rows without label, key, or text teach nothing.
    """
    named = df.where(F.col(lang).isNotNull() & F.col(key).isNotNull() & F.col(text).isNotNull())
    order = Window.partitionBy("lang").orderBy("h", "k")
    ranked = named.select(F.col(key).alias("k"), F.col(lang).alias("lang"), F.xxhash64(key).alias("h"))
    chosen = ranked.withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample_docs).select("k").distinct()
    keys = [r[0] for r in chosen.collect()]
    share = sample_chars // 8
    rows = (
        named.where(F.col(key).isin(keys))
        .select(F.col(lang).alias("lang"), F.xxhash64(key).alias("h"), F.substring(text, 1, share).alias("t"))
        .distinct()
        .collect()
    )
    texts: dict[str, str] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["h"], r["t"])):
        held = texts.get(row["lang"], "")
        texts[row["lang"]] = (held + " " + row["t"])[:sample_chars]
    return Samples(tuple(sorted(texts.items())))


def suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """The transitions of the automaton of all substrings, by state; state 0 is the empty one."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols.tolist():
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Transitions:
    """The automaton of one sample as arrays: a table for the most frequent symbols, sorted keys for all others.

    A sample of n symbols has at most 2n states and 3n transitions, so a language takes at most 2n * DENSE * 4 bytes
    for the table (17 MB for 32 768 characters) and 12 bytes for each other transition, whatever its alphabet.
    """

    def __init__(self, sample: np.ndarray, width: int) -> None:
        states = suffix_automaton(sample)
        self.width, self.dense = width, min(width, DENSE)
        of = np.repeat(np.arange(len(states)), [len(s) for s in states])
        symbol = np.fromiter((c for s in states for c in s), dtype=np.int64, count=len(of))
        to = np.fromiter((t for s in states for t in s.values()), dtype=np.int32, count=len(of))
        table = np.full((len(states), self.dense), -1, dtype=np.int32)
        near = symbol < self.dense
        table[of[near], symbol[near]] = to[near]
        table[:, UNKNOWN], table[:, PAD] = -1, np.arange(len(states))
        self.flat = table.ravel()
        keys = of[~near] * width + symbol[~near]
        order = np.argsort(keys)
        self.keys, self.to = keys[order], to[~near][order]

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        if self.width <= self.dense:
            return self.flat[state * self.dense + symbol]
        far = np.flatnonzero(symbol >= self.dense)
        out = self.flat[state * self.dense + np.where(symbol < self.dense, symbol, UNKNOWN)]
        if len(far) and len(self.keys):
            wanted = state[far] * self.width + symbol[far]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            out[far] = np.where(self.keys[at] == wanted, self.to[at], -1)
        return out

    def walk(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a symbol each, and whether a phrase starts with it.

        The longest match goes on, or ends before the symbol; a symbol that the sample lacks is a phrase by itself.
        """
        to = self.step(state, symbol)
        failed = np.flatnonzero(to < 0)
        starts = state == 0
        if len(failed):
            starts[failed] = True
            to[failed] = np.maximum(self.step(np.zeros(len(failed), dtype=np.int64), symbol[failed]), 0)
        return to.astype(np.int64), starts & (symbol != PAD)

    def phrases(self, square: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """The number of phrases that start in each lane (column); ``follows`` tells lanes that go on with the one before.

        All lanes are parsed from their start first. Then the last match of a lane runs on into the next one until both
        parses start a phrase at the same symbol, from where they agree. Where they never do, the next lane is done
        again with the state that arrives there, so the result is that of parsing the whole text in one go.
        """
        lanes = square.shape[1]
        begun = np.zeros(square.shape, dtype=bool)
        state = np.zeros(lanes, dtype=np.int64)
        for i, row in enumerate(square):
            state, begun[i] = self.walk(state, row)
        alone, end = state, state.copy()  # the states after each lane: parsed by itself, and as far as known
        counts = begun.sum(0)
        total, arrived = counts.copy(), np.zeros(lanes, dtype=np.int64)
        redo = np.flatnonzero(follows)
        redo = redo[end[redo - 1] != 0]
        while len(redo):
            arrived[redo] = end[redo - 1]
            total[redo], end[redo] = counts[redo], alone[redo]
            on, state = redo, arrived[redo]
            for i, row in enumerate(square):
                state, starts = self.walk(state, row[on])
                first = begun[i, on]
                total[on] += starts.astype(np.int64) - first
                apart = ~(starts & first)
                on, state = on[apart], state[apart]
                if not len(on):
                    break
            end[on] = state
            # only a lane whose end has changed changes what arrives in the next one
            after = redo + 1
            after = after[after < lanes]
            redo = after[follows[after] & (end[after - 1] != arrived[after])]
        return total


class Parser:
    """The automata of all samples, and how they parse many texts side by side."""

    def __init__(self, samples: Samples) -> None:
        self.names = [name for name, _ in samples.texts]
        own = [Counter(c for c in text.lower() if c.isalpha()) for _, text in samples.texts]
        letters = sorted(set().union(*own))
        self.symbol = np.full(0x110000, GAP, dtype=np.int32)
        self.symbol[code_point_classes() == LETTER] = UNKNOWN
        for i, c in enumerate(letters):
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1:
                    self.symbol[ord(form)] = LETTERS + i
        number = {c: LETTERS + i for i, c in enumerate(letters)}
        self.local, self.parsers, self.bits = [], [], []
        for (_, text), seen in zip(samples.texts, own):
            # symbols of the language: its own letters, the most frequent ones first
            local = np.full(LETTERS + len(letters), UNKNOWN, dtype=np.int32)
            local[[GAP, PAD]] = GAP, PAD
            for i, c in enumerate(sorted(seen, key=lambda c: (-seen[c], c))):
                local[number[c]] = LETTERS + i
            coded, _ = self._coded([text])
            self.local.append(local)
            self.parsers.append(Transitions(local[coded], LETTERS + len(seen)))
            self.bits.append(np.log2(max(len(coded), 2)))

    def _coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, runs of other characters being one gap, and their number in each text."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = self.symbol[points]
        of = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
        new = np.ones(len(points), dtype=bool)
        new[1:] = (symbols[1:] != GAP) | (symbols[:-1] != GAP) | (of[1:] != of[:-1])
        return symbols[new], np.bincount(of[new], minlength=len(texts))

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a symbol of every text (rows) in every language, and whether the text has a letter."""
        symbols, sizes = self._coded(texts)
        lanes = -(-sizes // LANE)
        before = np.cumsum(lanes) - lanes
        # one index at a time: each of them is eight times as large as the text
        at = np.arange(len(symbols))
        at += np.repeat(before * LANE - (np.cumsum(sizes) - sizes), sizes)
        laid = np.full(int(lanes.sum()) * LANE, PAD, dtype=np.int32)
        laid[at] = symbols
        del at, symbols
        laid = laid.reshape(-1, LANE)
        text_of = np.repeat(np.arange(len(texts)), lanes)
        lettered = np.bincount(text_of, weights=((laid != GAP) & (laid != PAD)).any(1), minlength=len(texts)).astype(bool)
        square = np.ascontiguousarray(laid.T)
        del laid
        follows = np.zeros(len(text_of), dtype=bool)
        follows[1:] = text_of[1:] == text_of[:-1]
        out = np.zeros((len(texts), len(self.parsers)))
        for k, (parser, local, bits) in enumerate(zip(self.parsers, self.local, self.bits)):
            phrases = parser.phrases(local[square], follows)
            out[:, k] = np.bincount(text_of, weights=phrases, minlength=len(texts)) * bits / np.maximum(sizes, 1)
        return out, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of every text, and how much cheaper it is than the second (0 to 1)."""
        none = np.array([t is None for t in texts])
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        costs, lettered = self.costs([t or "" for t in texts])
        best = costs.argmin(1)
        ordered = np.sort(costs, axis=1)
        second = ordered[:, 1] if len(self.names) > 1 else np.full(len(texts), np.inf)
        score = 1 - ordered[:, 0] / np.maximum(second, 1e-300)
        known = lettered & ~none
        names = [self.names[b] if ok else UNDETERMINED for b, ok in zip(best, known)]
        return names, np.where(known, np.clip(score, 0, 1), 0.0)


def _told(parser: Parser, texts: pa.Array) -> Iterator[pa.Array]:
    """Predictions of a batch, which may be all texts of a task: only those of one group are strings at a time."""
    for group in batches(t.as_py() for t in texts):
        names, scores = parser.predict(group)
        yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])


def language(spark: SparkSession, text: Column, samples: Samples) -> Column:
    """A struct of every whole text: ``lang`` (``und`` for null and for texts without a letter) and ``score``.

    Only the samples are broadcast (languages * ``sample_chars`` characters); workers build the automata.
    Equal costs go to the language that comes first by name. Without any sample all texts are ``und``.
    """
    shared = spark.sparkContext.broadcast(samples)

    @F.arrow_udf("lang string, score double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = held(shared.value, lambda: Parser(shared.value))
        for texts in columns:
            yield from _told(parser, texts)

    # else a filter on the result would run it once more
    return of.asNondeterministic()(text)


def held_out(key: Column) -> Column:
    """The fold that nothing is learned from: crc32 of the key as text is 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
