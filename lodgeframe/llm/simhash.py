"""SimHash near-duplicates: fingerprints, candidates by chains of a ring of segments, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeframe.llm.components import components
from lodgeframe.llm.names import free_name
from lodgeframe.session import checkpointed, scratch_path

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_PIECE = 100_000  # shingles hashed at a time, so that a very long text needs bounded memory


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def fingerprint_of(text: str | None, words: int = 4, seed: int = 42) -> int:
    """64 bits as a signed integer; zero for a null text or one without words."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(found) - words, 0)
    begin, end = starts[: last + 1].tolist(), ends[min(words, len(found)) - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(begin), _PIECE):
        spans = zip(begin[at : at + _PIECE], end[at : at + _PIECE])
        hashes = np.array([digest(joined[i:j], seed) for i, j in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(begin)).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int = 4, seed: int = 42) -> Column:
    """The SimHash of the XXH64 hashes of all word shingles of a whole text."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint_of(t, words, seed) for t in batch], dtype="int64")

    return of(text)


class Ring:
    """The segments of a fingerprint in a circle, and what two fingerprints within ``distance`` must share.

    For m segments, some start has every chain of l consecutive segments (l = 1..m) differ in at most
    l * distance / m bits. Up to ``chain`` segments that leaves few choices which of them may differ at all;
    each largest choice gives a table keyed by the segments that may not.
    """

    def __init__(self, distance: int = 4, segments: int = 9, chain: int = 6) -> None:
        if distance < 0 or distance % 2 or not 1 <= chain <= segments <= 64:
            raise ValueError("distance must be even, chain at most segments, segments at most 64")
        self.distance = distance
        edges = [round(k * 64 / segments) for k in range(segments + 1)]
        parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
        budget = [length * distance // segments for length in range(segments + 1)]
        #: for each start, (mask of the chain, bits it may differ in), by length
        self.chains: list[list[tuple[int, int]]] = []
        #: (start, mask of the segments that must agree)
        self.tables: list[tuple[int, int]] = []
        for start in range(segments):
            ring = [parts[(start + k) % segments] for k in range(segments)]
            self.chains.append([(_signed(sum(ring[: k + 1])), budget[k + 1]) for k in range(segments)])
            free = [
                set(d)
                for size in range(budget[chain] + 1)
                for d in combinations(range(chain), size)
                if all(sum(x < k for x in d) <= budget[k] for k in range(chain + 1))
            ]
            for d in free:
                if not any(d < other for other in free):
                    self.tables.append((start, _signed(sum(p for k, p in enumerate(ring[:chain]) if k not in d))))

    def keys(self, fp: Column) -> Column:
        """(table, key) of every table, as an array to explode."""
        return F.array(
            *(F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(mask)).alias("k")) for t, (_, mask) in enumerate(self.tables))
        )

    def linked(self, x: str, y: str, table: str) -> Column:
        """Whether two fingerprints of one bucket are linked and this is the first table that finds them.

        The chain of the table's start is checked first, the whole distance after it.
        """
        chains = ", ".join(
            "array(" + ", ".join(f"named_struct('m', {m}L, 'b', {b})" for m, b in chain) + ")" for chain in self.chains
        ).replace(f"{-(1 << 63)}L", f"({-(1 << 63) + 1}L - 1L)")
        tables = ", ".join(
            f"named_struct('t', {t}, 's', {start}, 'm', {mask}L)" for t, (start, mask) in enumerate(self.tables)
        ).replace(f"{-(1 << 63)}L", f"({-(1 << 63) + 1}L - 1L)")
        starts = ", ".join(str(start) for start, _ in self.tables)
        diff = f"({x} ^ {y})"
        fits = f"forall(element_at(array({chains}), %s + 1), p -> bit_count({diff} & p.m) <= p.b)"
        first = f"filter(array({tables}), s -> ({diff} & s.m) = 0L AND {fits % 's.s'})"
        return F.expr(
            f"{fits % f'element_at(array({starts}), {table} + 1)'} AND bit_count({diff}) <= {self.distance} "
            f"AND element_at({first}, 1).t = {table}"
        )


def links(prints: DataFrame, fp: str = "fp", ring: Ring | None = None, crowd: int = 1000) -> DataFrame:
    """(a, b): links of distinct fingerprints that have the same components as all pairs within the distance.

    Buckets of two come straight from the count. In larger ones every pair is checked up to ``crowd``
    members; beyond it, every member of a crowded bucket emits all values within half the distance, and
    those that share a value are tied to the smallest of them: two fingerprints are within the distance
    exactly if they share such a value, and the work stays in proportion to the members.
    """
    ring = ring or Ring()
    spark = prints.sparkSession
    keyed = prints.select(F.col(fp).alias("fp"), F.explode(ring.keys(F.col(fp))).alias("e")).select("fp", "e.t", "e.k")
    counted = (
        keyed.groupBy("t", "k")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1")
    )
    path = scratch_path(spark, "buckets")
    counted.write.parquet(path)
    buckets = spark.read.parquet(path)
    twos = buckets.where("n = 2").where(ring.linked("a", "b", "t")).select("a", "b")
    members = checkpointed(keyed.join(buckets.where("n > 2").select("t", "k", "n"), ["t", "k"]))
    x, y = members.where(F.col("n") <= crowd).alias("x"), members.where(F.col("n") <= crowd).alias("y")
    more = x.join(
        y,
        (F.col("x.t") == F.col("y.t"))
        & (F.col("x.k") == F.col("y.k"))
        & (F.col("x.fp") < F.col("y.fp"))
        & ring.linked("x.fp", "y.fp", "x.t"),
    ).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    crowded = members.where(F.col("n") > crowd).select("fp").distinct()
    return twos.unionByName(more).unionByName(_through_middles(crowded, ring.distance // 2))


def _through_middles(prints: DataFrame, radius: int) -> DataFrame:
    """Links to the smallest fingerprint around every value within ``radius`` bits of two or more."""
    flips = [_signed(sum(1 << p for p in c)) for r in range(radius + 1) for c in combinations(range(64), r)]
    around = prints.select("fp", F.explode(F.transform(F.lit(flips), lambda f: f.bitwiseXOR(F.col("fp")))).alias("z"))
    smallest = around.groupBy("z").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("z", "a")
    tied = around.join(smallest, "z").where("fp <> a")
    return tied.select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", ring: Ring | None = None, crowd: int = 1000
) -> DataFrame:
    """(key, fp, component_id): the fingerprint of every row and the smallest key that links lead to.

    Equal fingerprints are one node, so copies cost nothing. Null and wordless texts share fingerprint
    zero. Null keys never name a component (a component of null keys only has a null name). Repeated rows
    are returned each; other columns are not carried. An empty table gives an empty result.
    """
    prints = checkpointed(df.select(F.col(key), fingerprint(F.col(text)).alias("fp")))
    nodes = checkpointed(prints.groupBy("fp").agg(F.min(key).alias("first")))
    rooted = components(links(nodes, "fp", ring, crowd)).withColumnRenamed("node", "fp")
    linked = checkpointed(rooted.join(nodes, "fp"))
    named = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    joined = linked.join(named, "root").select("fp", "component_id")
    alone = nodes.join(joined, "fp", "left_anti").select("fp", F.col("first").alias("component_id"))
    return prints.join(alone.unionByName(joined), "fp").select(key, "fp", "component_id")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of one document of each component: that with the smallest key. All columns stay.

    Rows without a key stay too, since nothing can refer to them. Of rows that repeat a key one stays, always the same:
    that whose content, all columns together, has the lowest SHA-256.
    """
    found = near_duplicates(df, key, text)
    kept, row = free_name("_kept", df.columns), free_name("_row", df.columns)
    names = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias(kept)).distinct()
    named = df.where(F.col(key).isNotNull()).join(names, F.col(key) == F.col(kept), "left_semi")
    whole = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns))
    one = named.groupBy(key).agg(F.min_by(whole, F.sha2(F.to_json(whole), 256)).alias(row)).select(f"{row}.*")
    return one.unionByName(df.where(F.col(key).isNull()))
