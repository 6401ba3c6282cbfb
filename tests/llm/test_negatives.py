from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgeframe.llm import negatives as N


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(1, 40), st.integers(0, 40), st.integers(1, 5), st.integers(0, 99))
def test_strassen_is_exact(m, k, n, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-(1 << 28), 1 << 28, size=s) for s in ((m, k), (k, n)))
    want = a.astype(object) @ b.astype(object)
    assert (N.strassen(a, b, leaf) == want).all()
    assert (N.strassen(a.astype(object) << 40, b.astype(object), leaf) == want << 40).all()


def test_scores_beyond_the_tile():
    rng = np.random.default_rng(3)
    a, b = rng.integers(-500, 500, size=(70, 65)), rng.integers(-500, 500, size=(131, 65))
    assert (N.scores(a, b) == a @ b.T).all()
    big = np.array([[1 << 40, 3]])
    assert N.scores(big, np.array([[1 << 22, -5]]))[0, 0] == (1 << 62) - 15
    with pytest.raises(OverflowError):
        N.scores(big, big)


def plain(rows, low=80, high=100, k=5):
    """rows: distinct (id, label, vector). Brute force over all pairs."""
    ok = [r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[2])]
    ok = [(i, lab, tuple(math.floor(256 * x) for x in v)) for i, lab, v in ok]
    out = []
    for i, lab, v in {r for r in ok if r[0] % 100 == 0}:
        scored = {(-sum(x * y for x, y in zip(v, w)), j, lab == m) for j, m, w in ok if j != i}
        for s, p, _ in sorted(x for x in scored if x[2])[:k]:
            fits = sorted({x[:2] for x in scored if not x[2] and low * -s <= 100 * -x[0] <= high * -s})[:k]
            out += [(i, p, r + 1, j, -s, -t) for r, (t, j) in enumerate(fits)]
    return sorted(out)


def vectors(n, dim, seed, labels=3):
    rng = random.Random(seed)
    base = [[rng.choice((-0.5, -0.25, 0.0, 0.25, 0.5)) for _ in range(dim)] for _ in range(9)]
    return [(i, rng.randrange(labels), [x + rng.choice((0, 0, 0.01)) for x in rng.choice(base)]) for i in range(n)]


@pytest.mark.parametrize("tile", [2048, 64])
def test_against_brute_force(spark, tile):
    rows = vectors(700, 9, 1)
    rows += [(1000, None, [0.1] * 9), (1001, 1, None), (None, 1, [0.5] * 9), (1100, 0, [0.5, None, 0.5]), (1200, 1, [float("nan")]), (1300, 1, [float("inf")])]
    rows += [(1400, 2, [0.5, 0.25]), (1500, 1, []), (1600, 7, [0.3] * 9)]  # a short one, an empty one, a label of its own
    df = spark.createDataFrame([(*r, 5) for r in [*rows, *rows[:40]]], "vec_id long, label int, vector array<double>, rank int").repartition(5)
    got = N.hard_negatives(df, F.col("vec_id") % 100 == 0, tile=tile)
    assert sorted(map(tuple, got.collect())) == plain(rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_ties_and_a_hot_label(spark):
    rows = [(i, 0 if i % 3 else 1, [0.5, 0.5]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>").repartition(4)
    got = N.hard_negatives(df, F.col("vec_id") % 100 == 0, tile=32)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_ids_that_repeat_with_other_vectors(spark):
    rows = vectors(60, 4, 2) + [(0, 1, [0.4, 0.4, 0.4, 0.4]), (3, 1, [0.5, 0.5, 0.0, 0.0]), (3, 1, [0.5, 0.0, 0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    got = sorted(map(tuple, N.hard_negatives(df, F.col("vec_id") % 100 == 0, tile=8).collect()))
    assert got == plain(rows)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, label int, vector array<float>")
    assert N.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0
