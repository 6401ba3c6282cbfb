from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodgeframe.llm import bpe, pii
from lodgeframe.llm import language as L
from tests.helpers import plan
from tests.llm.cases import DOCS, documents, empty


def spoken(lang: str, seed: int, n: int) -> str:
    parts = {"aa": "ba be bi bo", "bb": "kru kro kli klo", "cc": "éna éni ona oni"}[lang].split()
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.lists(st.integers(0, 3), min_size=1, max_size=40))
def test_automaton_knows_exactly_the_substrings(text, query):
    states = L.suffix_automaton(np.array(text))
    state, inside = 0, True
    for i, c in enumerate(query):
        state = states[state].get(c, -1) if inside else -1
        inside = inside and state >= 0
        part = query[: i + 1]
        assert inside == any(text[k : k + len(part)] == part for k in range(len(text)))


def plain_phrases(text: str, sample: str) -> int:
    """Longest matches in turn; a symbol that the sample lacks is a phrase by itself."""
    n = at = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        at += max(size, 1)
        n += 1
    return n


def test_parser_counts_longest_matches():
    """Whole texts of many lanes, in several languages, against longest matches found by search."""
    rng = random.Random(3)
    many = "".join(chr(0x4E00 + i) for i in range(3 * L.DENSE))
    drawn = "".join(rng.choice(many) for _ in range(900))
    samples = {"aa": spoken("aa", 1, 300), "bb": spoken("bb", 2, 300), "cc": drawn, "dd": "xyxx xy" * 9}
    parser = L.Parser(L.Samples(tuple(samples.items())))
    texts = [spoken(rng.choice(["aa", "bb"]), rng.randrange(9), rng.randint(1, 400)) for _ in range(12)]
    # phrases over many lanes, phrases that never fall in step with the lanes, letters outside the dense table
    texts += [samples["aa"], samples["aa"] * 3, "x" * 2000, "xyx" * 700, drawn * 2, drawn[5:700] + "q" + drawn[9:800], "q" * 600, "x"]
    assert max(map(len, texts)) > 4 * L.LANE and len(set(many)) > L.DENSE
    texts = [" ".join(t.split()) for t in texts]
    costs, lettered = parser.costs(texts)
    assert lettered.all()
    names, _ = parser.predict(texts)
    for row, text, name in zip(costs, texts, names):
        want = [plain_phrases(text, sample) * bits / len(text) for sample, bits in zip(samples.values(), parser.bits)]
        assert np.allclose(row, want, rtol=1e-12, atol=0)
        assert name == list(samples)[int(np.argmin(want))]
    alone = np.vstack([parser.costs([t])[0] for t in texts])
    assert np.allclose(alone, costs)


def most_held(results) -> int:
    tracemalloc.start()
    for _ in results:
        pass
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return held


def test_no_batch_is_strings_as_a_whole():
    """What workers hold beside a batch grows with a group of texts, not with the batch."""
    text = " ".join(spoken(lang, 1, 800) for lang in ("aa", "bb", "cc"))
    parser = L.Parser(L.Samples((("aa", spoken("aa", 1, 99)), ("bb", spoken("bb", 2, 99)))))
    sizes = [2, 6]  # millions of characters
    columns = [pa.array([None, *[text] * (n * 10**6 // len(text))]) for n in sizes]
    assert [sum(len(part) for part in L._told(parser, c)) for c in columns] == list(map(len, columns))
    told = [most_held(L._told(parser, c)) for c in columns]
    cache, length = bpe.PieceCache(lambda new: ([0] for _ in new)), np.array([1], dtype=np.int32)
    parts = [pa.RecordBatch.from_pydict({"text": c}) for c in columns]
    coded = [most_held(bpe._encoded(part, "text", cache, length)) for part in (parts[0], *parts)][1:]
    assert told[1] - told[0] < 2e6 and coded[1] - coded[0] < 2e6


def test_every_letter_of_a_sample_counts():
    """More letters than any fixed alphabet would hold, told apart by the rare ones."""
    wide = {n: "".join(chr(0x4E00 + 2 * i + k) for i in range(2000)) for k, n in enumerate(["even", "odd"])}
    parser = L.Parser(L.Samples(tuple(wide.items())))
    assert parser.predict([wide["odd"][1500:1600], wide["even"][1900:]])[0] == ["odd", "even"]


def test_held_out_accuracy_and_rejection(spark):
    rows = [(i, spoken(lang, i, 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = L.held_out(F.col("doc_id"))
    samples = L.fit(df.where(~out), sample_chars=4000)
    assert [n for n, _ in samples.texts] == ["aa", "bb", "cc"] and all(len(t) <= 4000 for _, t in samples.texts)
    assert samples == L.fit(df.where(~out).repartition(7), sample_chars=4000)
    got = df.where(out).select("lang", L.language(spark, F.col("text"), samples).alias("p")).select("lang", "p.lang", "p.score").collect()
    assert len(got) > 30 and all(a == b and 0 < s <= 1 for a, b, s in got)
    odd = {r.doc_id: r.p for r in documents(spark).select("doc_id", L.language(spark, F.col("text"), samples).alias("p")).collect()}
    assert len(odd) == len({d[0] for d in DOCS})
    assert [odd[k].lang for k in (3, 4, 6, 7)] == ["und"] * 4 and odd[8].lang != "und" and odd[4].score == 0
    assert L.fit(empty(spark)).texts == ()
    untaught = documents(spark).select(L.language(spark, F.col("text"), L.Samples(())).alias("p")).select("p.lang").distinct().collect()
    assert [r[0] for r in untaught] == ["und"]


# The patterns of the contract, as plain regular expressions.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def counts(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain_spans(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if counts(k, m[0])] for k, p in PLAIN.items()}


def test_base_spans(spark):
    rng = random.Random(3)
    bits = ["a", "b@", "@c", ".d", ".", "1", "22", "4111 1111 1111 1111", "+1 (", "555-", "1.2.3.4", ".5", " ", "-", "é", "😀",
            "0012", "256.1.1.1", "+12345678901", "_", "%", "x@y.z", "\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += [None, "", "1 " * 40_000, "a.b@" + "c." * 20_000 + "d", "x" * 150_000, "+1" + " " * 50_000, "1" * 60_000, "a@b.c " * 3000, "a-" * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    for r in pii.base_spans(df, "text").drop("text").collect():
        assert {k: [tuple(s) for s in r[k]] for k in PLAIN} == plain_spans(texts[r.doc_id])


@pytest.fixture(scope="module")
def mail(spark):
    rng = random.Random(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = []
    for i in range(90):
        known = f"bob{i}@mail.example.com" if i % 3 else f"+1 (555) 555-{1000 + i}"
        rows.append((i, f"{prose(20)} reach me: {known} or {prose(20)}", 1))
    for i in range(300, 320):
        rows.append((i, f"{prose(9)} reach me: HANDLE-{i}77 or {prose(9)} version 2024.10 {prose(3)} build 123456 é", 1))
    rows += [(400, None, 1), (401, "", 1), (402, "clean words only", 1), (0, "another row of key 0", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, id int").repartition(4)


def test_contexts_find_unseen_identifiers_only(mail):
    rows, df = mail
    texts = {(k, t) for k, t, _ in rows}
    found = pii.find_pii(df).join(df.selectExpr("doc_id AS k", "text", "xxhash64(text) AS h"), F.expr("k = doc_id AND h = r"))
    table = found.collect()
    assert len(table) == len(rows) == len(texts)
    got = {r.doc_id: [r.text[s.start : s.end] for s in r.id] for r in table if r.id}
    assert got == {i: [f"HANDLE-{i}77"] for i in range(300, 320)}
    assert sum(len(r.email) + len(r.phone) for r in table) == 90


def test_contexts_glued_to_an_identifier_count(spark):
    rng = random.Random(7)
    prose = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(6))
    forms = {"quoted": 'user key="{}" then', "bracketed": "owner (ID:{}), of", "pair": "login tel:{} at", "comma": "name said {}, so"}
    rows, want = [], {}
    for f, form in enumerate(forms.values()):
        for i in range(30):
            rows.append((1000 * f + i, f"{prose()} {form.format(f'bob{f}x{i}@mail.example.com')} {prose()}"))
        for i in range(30, 36):
            want[1000 * f + i] = [f"HANDLE-{f}{i}77"]
            rows.append((1000 * f + i, f"{prose()} {form.format(want[1000 * f + i][0])} {prose()}"))
    # slots that mostly hold other words do not make an identifier, glued or not
    rows += [(9000 + i, f"{prose()} see <{'amy' + str(i) + '@mail.example.com' if i < 20 else prose()[:5]}> more") for i in range(200)]
    rows += [(9900 + i, f"{prose()} see <chapter-{i}12> more") for i in range(5)]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    texts = dict(rows)
    assert {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.id] for r in found if r.id} == want


def test_masking(mail):
    rows, df = mail
    got = pii.mask(df)
    assert got.columns == df.columns
    table = {(r.doc_id, r.text) for r in got.collect()}
    assert len(table) == len(rows) and (400, None) in table and (402, "clean words only") in table
    joined = " ".join(t or "" for _, t in table)
    assert joined.count("[EMAIL]") == 60 and joined.count("[PHONE]") == 30 and joined.count("[ID]") == 20
    assert "@" not in joined and "HANDLE" not in joined and joined.count("2024.10") == 20


def test_main_path_is_native(spark):
    assert "Python" not in plan(pii.find_pii(documents(spark))) and "Arrow" not in plan(pii.find_pii(documents(spark)))
    assert pii.find_pii(documents(spark)).count() == len(DOCS)
    assert pii.find_pii(empty(spark)).count() == 0 and pii.mask(empty(spark)).count() == 0
