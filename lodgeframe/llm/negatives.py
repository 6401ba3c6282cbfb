"""Hard negatives: exact integer scores by Strassen products of tiles, kept in heaps that merge."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeframe.session import checkpointed

TILE = 2048  # anchors and candidates of a cell
LEAF = 32  # sides up to which a product is taken directly


def _even(a: np.ndarray) -> np.ndarray:
    """The matrix with a row and a column of zeros more where their number is odd."""
    m, n = a.shape
    if not (m % 2 or n % 2):
        return a
    out = np.zeros((m + m % 2, n + n % 2), dtype=a.dtype)
    out[:m, :n] = a
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two integer matrices of any shape by seven half-size products at each level.

    Sides are padded with zeros to even lengths. Sums wrap modulo 2^64, where all steps are exact, so the result is
    exact wherever the true one fits; integers of any size (object arrays) never wrap.
    """
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    x, y, z = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:x, :y], a[:x, y:], a[x:, :y], a[x:, y:]
    b11, b12, b21, b22 = b[:y, :z], b[:y, z:], b[y:, :z], b[y:, z:]
    out = np.empty((2 * x, 2 * z), dtype=a.dtype)
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    out[:x, :z] = p1 + p4 - p5 + strassen(a12 - a22, b21 + b22, leaf)
    out[:x, z:] = p5
    out[x:, :z] = p4
    p3 = strassen(a11, b12 - b22, leaf)
    out[:x, z:] += p3
    p2 = strassen(a21 + a22, b11, leaf)
    out[x:, :z] += p2
    out[x:, z:] = p1 - p2 + p3 + strassen(a21 - a11, b11 + b12, leaf)
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two int64 matrices; those beyond 64 bits raise."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = a.shape[1] * max(abs(int(a.min())), int(a.max())) * max(abs(int(b.min())), int(b.max()))
    if most < 1 << 63:
        return strassen(a, b.T)
    return strassen(a.astype(object), b.T.astype(object)).astype(np.int64)


def best(row: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of the given places the k with the largest values, in that order; ties by the smaller place."""
    found = row[places]
    if len(places) > k:
        least = np.partition(found, len(found) - k)[len(found) - k]
        places = places[found >= least]
        found = row[places]
    return places[np.argsort(-found, kind="stable")[:k]]


def _vectors(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The lists of a column as rows of one matrix, shorter ones filled up with zeros."""
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(flat) == len(lengths) * width:
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


class Tile:
    """The anchors and candidates of a cell; candidates stand in the order of their ids, so ties go to the first."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table) -> None:
        self.anchors, self.candidates = anchors, candidates.sort_by("id")
        width = max((pa.compute.max(pa.compute.list_value_length(t["v"])).as_py() or 0) for t in (anchors, candidates))
        self.a, self.b = (_vectors(t["v"], width) for t in (self.anchors, self.candidates))
        self.ids = self.candidates["id"].to_numpy()
        self.a_label, self.b_label = (t["label"].to_numpy() for t in (self.anchors, self.candidates))


def _distinct(ids: np.ndarray, row: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places whose (id, value) has not come before; repeated ids stand side by side."""
    if not len(places) or (np.diff(ids[places]) != 0).all():
        return places
    pairs = np.stack([ids[places], row[places]])
    return places[np.sort(np.unique(pairs, axis=1, return_index=True)[1])]


def positive_heaps(tile: Tile, k: int):
    """(anchor row, id, score): of each anchor the k best other candidates of its label. Only rows of a label are multiplied."""
    own = tile.anchors["id"].to_numpy()
    for label in np.unique(tile.a_label):
        of, among = np.flatnonzero(tile.a_label == label), np.flatnonzero(tile.b_label == label)
        product = scores(tile.a[of], tile.b[among])
        ids = tile.ids[among]
        for i, row in zip(of.tolist(), product):
            places = best(row, _distinct(ids, row, np.flatnonzero(ids != own[i])), k)
            yield from ((i, int(ids[p]), int(row[p])) for p in places)


def window_heaps(tile: Tile, k: int, low: int, high: int):
    """(anchor row, positive id, positive score, id, score): for each anchor and positive the k best candidates of other
    labels whose score times 100 lies from ``low`` to ``high`` times that of the positive."""
    product = scores(tile.a, tile.b)
    wanted, own = tile.anchors["positives"].to_pylist(), tile.anchors["id"].to_numpy()
    for i, row in enumerate(product):
        others = _distinct(tile.ids, row, np.flatnonzero((tile.b_label != tile.a_label[i]) & (tile.ids != own[i])))
        found = row[others]
        for positive in wanted[i]:
            p = positive["score"]
            least, most = -(-low * p // 100), high * p // 100  # in Python's integers, which have no end
            if least > most:
                continue
            for place in best(row, others[(found >= least) & (found <= most)], k):
                yield i, positive["id"], p, int(tile.ids[place]), int(row[place])


def _cells(anchors: DataFrame, candidates: DataFrame, stripes: int, groups: int, heaps: Callable, schema: str) -> DataFrame:
    """``heaps(tile)`` over the grid of anchor groups and candidate stripes.

    Anchors are dealt to all stripes and candidates to all groups, each by a hash of the whole row, so a cell holds
    about ``TILE`` of both whatever the labels are, and what is shuffled falls with the tile's side.
    """
    across = anchors.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    down = candidates.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = pa.schema([(n, pa.int64()) for n in names])

    def fill(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return kinds.empty_table()
        tile = Tile(left, right)
        rows = list(heaps(tile))
        columns = list(zip(*rows)) if rows else [()] * (len(names))
        keys = left["anchor"].to_numpy()[np.array(columns[0], dtype=np.int64)]
        return pa.table([pa.array(c, pa.int64()) for c in (keys, *columns[1:])], schema=kinds)

    return across.groupBy("group", "stripe").cogroup(down.groupBy("group", "stripe")).applyInArrow(fill, schema)


def merged(heaps: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The heaps of all cells as one for each key: the k highest scores with their ``rank``, ties by the smaller id.

    A heap of heaps is a heap: each task lets through its k best of a key before the shuffle. Equal entries count once.
    """
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return heaps.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k).distinct()


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    tile: int = TILE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``anchors`` holds.

    A component x counts as floor(scale * x), a score is the exact inner product of two rows. An anchor's positives
    are the ``positives`` best other rows of its label; for each, the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. Ties go to the smaller key.

    Rows with a null key, label, vector or component, or one that is not finite, take no part. Rows that repeat
    everything count once; of rows that share a key only, each counts, but none is the other's partner, and two with
    the same score are one partner. Shorter vectors are filled up with zeros. Labels are integers. Scores beyond 64 bits
    raise. The search is exact: every anchor meets every row, in tiles. An empty table gives an empty result; extra columns are not read.
    """
    value = lambda x: F.floor(F.lit(scale) * x.cast("double"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    known = F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("raw", finite), F.lit(False))
    rows = df.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("raw"), anchors.alias("asks")
    )
    rows = rows.where(known).select("id", "label", F.transform("raw", value).alias("v"), F.coalesce("asks", F.lit(False)).alias("asks"))
    rows = checkpointed(rows.distinct().withColumn("anchor", F.monotonically_increasing_id()))
    n, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    stripes, groups = max(1, -(-n // tile)), max(1, -(-asking // tile))
    dealt = F.xxhash64("id", "label", "v")
    candidates = rows.select("id", "label", "v", F.pmod(dealt, F.lit(stripes)).cast("int").alias("stripe"))
    # dealt by other bits than the stripes
    asked = rows.where("asks").select("anchor", "id", "label", "v", F.pmod(F.xxhash64(dealt), F.lit(groups)).cast("int").alias("group"))
    found = _cells(asked, candidates, stripes, groups, lambda t: positive_heaps(t, positives), "anchor long, id long, score long")
    heaps = merged(found, ["anchor"], positives)
    lists = heaps.groupBy("anchor").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    paired = checkpointed(asked.join(lists, "anchor"))
    schema = "anchor long, positive_id long, positive_score long, id long, score long"
    windows = _cells(paired, candidates, stripes, groups, lambda t: window_heaps(t, negatives, low, high), schema)
    ranked = merged(windows, ["anchor", "positive_id", "positive_score"], negatives)
    named = ranked.join(paired.select("anchor", F.col("id").alias("anchor_id")), "anchor")
    return named.select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
