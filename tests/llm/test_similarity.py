from __future__ import annotations

import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeframe.llm import decontaminate as D
from lodgeframe.llm import simhash as S
from lodgeframe.llm.components import components
from lodgeframe.llm.wordspan import words_of
from tests.llm.cases import DOCS, documents, empty, prose


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aAbÉé \n\t\x1c", max_size=60))
def test_fingerprints(text):
    assert S.fingerprint_of(text) == plain_print(text)


def test_hash_is_that_of_spark(spark):
    assert spark.sql("SELECT xxhash64('a b c d')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("ring", [S.Ring(), S.Ring(4, 9, 4), S.Ring(2, 8, 5), S.Ring(6, 16, 8)])
def test_some_chain_keeps_every_close_pair(ring):
    rng = random.Random(5)
    for _ in range(4000):
        diff = sum(1 << p for p in rng.sample(range(64), rng.randint(0, ring.distance)))
        assert any(
            diff & mask % 2**64 == 0 and all((diff & m % 2**64).bit_count() <= b for m, b in ring.chains[start])
            for start, mask in ring.tables
        )


def plain_components(prints):
    """Smallest fingerprint of the component of each."""
    todo, root = set(prints), {}
    while todo:
        group = {todo.pop()}
        front = list(group)
        while front:
            x = front.pop()
            near = {y for y in todo if ((x ^ y) % 2**64).bit_count() <= 4}
            todo -= near
            group |= near
            front += near
        root |= {x: min(group) for x in group}
    return root


def chained_prints(n=220):
    """Chains and clusters of near fingerprints, far beyond direct links, and loners."""
    rng = random.Random(8)
    out, x = set(), rng.getrandbits(64)
    for i in range(n):
        if i % 40 == 0:
            x = rng.getrandbits(64)
        for p in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << p
        out.add(x)
    centre = rng.getrandbits(64)
    out |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(80)}
    return [x - (1 << 64) if x >> 63 else x for x in out]


@pytest.mark.parametrize("crowd", [1000, 2])
def test_links_give_all_components(spark, crowd):
    prints = chained_prints()
    df = spark.createDataFrame([(p,) for p in prints], "fp long").repartition(5)
    got = {r.node: r.root for r in components(S.links(df, crowd=crowd)).collect()}
    want = plain_components(prints)
    alone = {p for p in prints if list(want.values()).count(want[p]) == 1}
    assert got == {p: want[p] for p in prints if p not in alone}


def test_components_of_a_chain_and_a_hub(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(500, 700)] + [(9, 9), (None, 3), (5, 4), (4, 5)]
    df = spark.createDataFrame(pairs, "x long, y long")
    got = {r.node: r.root for r in components(df, "x", "y").collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(500, 700)]} | {4: 4, 5: 4}
    assert components(df.limit(0), "x", "y").count() == 0


def test_near_duplicates_of_all_cases(spark):
    got = S.near_duplicates(documents(spark)).collect()
    assert len(got) == len(DOCS)
    prints = {d[0]: plain_print(d[1]) for d in DOCS}
    root = plain_components(set(prints.values()))
    for r in got:
        assert r.fp == prints[r.doc_id]
        mates = [k for k, p in prints.items() if k is not None and root[p] == root[prints[r.doc_id]]]
        assert r.component_id == min(mates, default=None)
    kept = sorted((r.doc_id or 0) for r in S.keep_one(documents(spark)).collect())
    assert kept == [0, 1, 3, 5, 7, 8] and S.keep_one(documents(spark)).columns == documents(spark).columns
    assert S.near_duplicates(empty(spark)).count() == 0 and S.keep_one(empty(spark)).count() == 0


def plain_contamination(docs, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    cut = lambda t: re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        w = cut(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for key, text in docs:
        w, hit, found = cut(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[x] - {None}
        out.append((key, len(w), len(hit), sorted(map(str, found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def order(table):
    return sorted(table, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))


def test_words_of_a_batch():
    texts = ["Ab c-9", None, "", "É中\x7fZ 'x", "end"]
    found = words_of(texts)
    got = [found.text(found.first[i], found.first[i + 1]) for i in range(5)]
    assert got == ["ab c 9", "", "", "É中 z x", "end"]
    same = words_of(["dog cat", "cat dog"]).hashes()
    assert same[0] == same[3] and same[1] == same[2] and same[0] != same[1]


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_contamination_is_exact(spark, bits):
    rng = random.Random(4)
    passage = [prose(40 + i, 30) for i in range(6)]
    items = [(i, p) for i, p in enumerate(passage)] + [(10, passage[0]), (11, "Short one!"), (12, "zyx"), (13, ""), (14, None), (None, passage[1])]
    docs = [(d[0], d[1]) for d in DOCS] + [
        (100 + i, " ".join([prose(90 + i, rng.randint(0, 400)), passage[i % 6].upper(), prose(70 + i, 9)])) for i in range(25)
    ] + [(200, "a short ONE: zyx zyx"), (201, " ".join(passage[0].split()[:12])), (202, "zyx"), (1, "another text under key 1 " + passage[2])]
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, n_hit int").repartition(4)
    marks = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, hash int")
    got = [tuple(r)[:1] + tuple(r)[2:] for r in D.contamination(df, marks, filter_bits=bits).collect()]
    assert order(got) == order(plain_contamination(docs, items))
    assert D.contamination(df.limit(0), marks).count() == 0
    clean = D.contamination(df, marks.limit(0))
    assert clean.count() == len(docs) and clean.where("contaminated").count() == 0
