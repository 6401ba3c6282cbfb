from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeframe.llm import collocations as C
from tests.helpers import plan
from tests.llm.cases import DOCS, documents, empty


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(docs, order=5, least=100, covered=100, top=2000):
    """docs: (text, lang). Every phrase counted by itself."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        for w in words_of(text):
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + m])) for m in range(1, order + 1) for i in range(len(w) - m + 1))
    often = {k: a for k, a in f.items() if a >= least}
    found, longer = {}, {}
    for (lang, p), a in often.items():
        for inner in {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1)} - {p}:
            longer[lang, inner] = max(a, longer.get((lang, inner), 0))
    for (lang, p), a in often.items():
        if len(p) < 2 or 100 * longer.get((lang, p), -1) >= covered * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in found.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])
    )


def got(df, **options):
    return sorted(map(tuple, C.collocations(df, **options).collect()))


TEXTS = [
    "a b c, a b c! a b\nA B C d e f g; x\ta  b", "the the the the the the", "É b É b É b", "a b c d e f. a b c d e f", "\x1c\x1d a\x0bb a\x0cb a\rb",
    ". . .", "...", " ", "", None, "b c b c b c b c", "\U0001f600 z \U0001f600 z ￿ z ￿ z", "a.b.c a b", "Z z Z z",
]


@pytest.mark.parametrize("order, least, covered, top, bits", [(5, 2, 100, 2000, 1 << 25), (5, 2, 60, 3, 64), (3, 3, 100, 5, 1 << 12), (2, 1, 100, 9, 64)])
def test_against_brute_force(spark, order, least, covered, top, bits):
    rng = random.Random(order * 7 + least)
    docs = [(t, lang) for t in TEXTS for lang in ("en", None, "und", "日本")]
    docs += [(" ".join(rng.choice("abcde") + rng.choice(("", "", ",")) for _ in range(rng.randint(0, 60))), rng.choice(("en", "fr"))) for _ in range(60)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "text string, lang string, n int").repartition(5)
    assert got(df, order=order, least=least, covered=covered, top=top, filter_bits=bits) == plain(docs, order, least, covered, top)


def test_all_cases(spark):
    docs = [(d[1], d[2]) for d in DOCS] * 3
    df = documents(spark)
    df = df.unionAll(df).unionAll(df)
    assert got(df, least=3) == plain(docs, least=3)
    assert got(df) == plain(docs) and plain(docs)
    assert got(empty(spark)) == [] and got(df.where("text = ''")) == []


def test_a_hot_language_with_many_small_ones(spark):
    docs = [("p q r s", f"l{i % 40}" if i % 3 else "hot") for i in range(900)]
    df = spark.createDataFrame(docs, "text string, lang string").repartition(9)
    assert got(df, least=10) == plain(docs, least=10)


def test_ties_are_ranked_by_their_bytes(spark):
    docs = [(f"{x} {y}", "en") for x, y in (("b", "c"), ("B1", "c1"), ("é", "ê"), ("\U0001f600", "q"), ("￿", "q2")) for _ in range(4)]
    found = got(spark.createDataFrame(docs, "text string, lang string"), least=4)
    assert found == plain(docs, least=4)
    assert [r[2] for r in found] == ["b c", "b1 c1", "é ê", "￿ q2", "\U0001f600 q"]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab .\t\n\x1cÉ", max_size=30), min_size=1, max_size=6), st.integers(1, 4))
def test_windows_count_every_word_once(texts, order):
    often = C.Filter(64)
    for _ in range(min(order, 3)):
        often.add(np.array([0]), np.array([2**64 - 1], dtype=np.uint64))
    tally = C.Windows("en", order, often)
    tally.add([t.encode() for t in texts])
    rows = tally.counts().to_pylist()
    assert sum(r["n"] for r in rows) == sum(len(w) for t in texts for w in words_of(t))
    want = Counter(tuple(w[i : i + order]) for t in texts for w in words_of(t) for i in range(len(w)))
    assert {tuple(r[f"w{k + 1}"] for k in range(order) if r[f"w{k + 1}"] is not None): r["n"] for r in rows if r["n"]} == want


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(1 << 45, 1 << 62, [(1, 1 << 60, 1 << 50), (2, 1 << 60, (1 << 50) + 1)])], "a long, total long, cuts array<struct<k:int,l:long,r:long>>")
    assert tuple(df.select(C._weakest().alias("c")).first().c) == (1000 * (1 << 107) // ((1 << 60) * ((1 << 50) + 1)), 2, 1 << 60, (1 << 50) + 1)


def test_a_task_sends_a_phrase_once(monkeypatch):
    """However often its words are counted; if it has too many phrases to hold, they go in parts without a loss."""
    monkeypatch.setattr(C, "_HELD", 20)
    docs = [("a b c, a b", lang) for lang in ("en", "fr") for _ in range(50)]
    batch = pa.RecordBatch.from_pydict({"text": [d[0] for d in docs], "lang": [d[1] for d in docs]})
    often = C.Filter(64)
    often.add(np.array([0]), np.array([2**64 - 1], dtype=np.uint64))
    want = {(lang, *w): 50 for lang in ("en", "fr") for w in (("a", "b", "c"), ("b", "c"), ("c",), ("a", "b"), ("b",))}
    for sent, once in ((1 << 20, True), (8, False)):
        monkeypatch.setattr(C, "_SENT", sent)
        parts = C._tallies(lambda lang: C.Windows(lang, 3, often))(iter([batch.slice(k, 1) for k in range(len(docs))]))
        rows = [r for part in parts for r in part.to_pylist() if r["n"]]
        found = Counter()
        for r in rows:
            found[tuple(v for k, v in r.items() if k != "n" and v is not None)] += r["n"]
        assert found == want and (len(rows) == len(want)) == once


def test_tasks_do_not_grow_with_partitions(spark):
    df = spark.createDataFrame([("a b", "en")] * 200, "text string, lang string").repartition(100)
    counted = C.phrase_counts(df, 2, 100, C.Filter(64))
    assert f"Coalesce {C.TASKS * spark.sparkContext.defaultParallelism}" in plan(counted)


def everything():
    often = C.Filter(64)
    for _ in range(3):
        often.add(np.array([0]), np.array([2**64 - 1], dtype=np.uint64))
    return often


def test_rows_are_sent_in_parts():
    """Strings are made for some rows at a time; no more than those stand in a batch, and none is lost."""
    words = [f"w{i}" for i in range(70_000)]
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(words)], "lang": ["en"]})
    parts = list(C._tallies(lambda lang: C.Windows(lang, 1, everything()))(iter([batch] * 2)))
    assert max(map(len, parts)) <= 1 << 16
    rows = [r for part in parts for r in part.to_pylist() if r["n"]]
    assert sorted((r["w1"], r["n"]) for r in rows) == sorted((w, 2) for w in words) and {r["lang"] for r in rows} == {"en"}


@pytest.mark.parametrize("make", [lambda often: C.Windows("en", 5, often), lambda often: C.Grams("en", often)])
def test_words_are_counted_a_part_at_a_time(make):
    """What a task holds does not grow with its words: four million of them took 300 MB and more."""
    batch = pa.RecordBatch.from_pydict({"text": ["a b c d e " * 10_000] * 2, "lang": ["en"] * 2})
    often = everything()
    tracemalloc.start()
    parts = list(C._tallies(lambda lang: make(often))(batch for _ in range(45)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    assert sum(sum(part["n"].to_pylist()) for part in parts) == 45 * 2 * (50_000 if "w1" in parts[0].schema.names else 49_997)


def test_many_languages_are_sent_before_they_pile_up(monkeypatch):
    """A language of few words takes memory as well."""
    monkeypatch.setattr(C, "_HELD", 1 << 12)
    monkeypatch.setattr(C, "_SENT", 1 << 12)
    read = []

    def batches():
        for i in range(100):
            read.append(i)
            yield pa.RecordBatch.from_pydict({"text": ["a b", "b"], "lang": [f"l{i}", "en"]})

    parts = C._tallies(lambda lang: C.Windows(lang, 1, everything()))(batches())
    found = Counter()
    for part in parts:
        assert len(read) < 50 or found
        for r in part.to_pylist():
            found[r["lang"], r["w1"]] += r["n"]
    assert +found == {("en", "b"): 100} | {(f"l{i}", w): 1 for i in range(100) for w in "ab"}


def test_long_text_in_small_groups(monkeypatch, spark):
    monkeypatch.setattr(C, "_GROUP", 50)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 60, "y z", "", "w " * 30, "v"], "lang": ["en", "en", "fr", "en", "en"]})
    runs = list(C._texts_by_lang(batch))
    assert sorted(t for lang, run in runs for t in run) == sorted(t.encode() for t in batch.to_pydict()["text"])
    assert all(len(run) == 1 or sum(map(len, run)) <= 50 for _, run in runs)
