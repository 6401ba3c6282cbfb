from __future__ import annotations

import re
from collections import Counter

import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from lodgeframe.llm import compression as C
from lodgeframe.llm import url_filter as U
from lodgeframe.llm.queries import URL_RULES
from tests.helpers import rows
from tests.llm.cases import DOCS, documents, empty


def plain_counts(text: str):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab #*\n\t\r\x0b\x1c\x85é", max_size=80))
def test_base_counts_match_the_contract(text):
    assert C.base_counts(text) == plain_counts(text)


def test_bands_reject_repetition_and_noise():
    z = zstandard.ZstdCompressor(level=3)
    import random

    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    clean = " ".join(rng.choice(vocabulary) for _ in range(2000))
    noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(9)) for _ in range(2000))
    half = clean[: len(clean) // 2] + " " + " ".join("spam" + str(i % 60) for i in range(3000))
    kept = [C.measure(t, z)[-1] for t in (clean, noise, half, "one two " * 500, "short text", None)]
    assert kept == [True, False, False, False, False, False]
    assert C.band_of(100, C.WHOLE) is None and C.band_of(900, C.WHOLE).from_bytes == 800


def test_the_tail_is_measured_like_the_head():
    import random

    z, rng = zstandard.ZstdCompressor(level=3), random.Random(2)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(2000)]
    prose = " ".join(rng.choice(vocabulary) for _ in range(1500))[:4096]
    lines = ("one line " + "-" * 89 + "\n") * 35
    assert len(prose) == 4096 and len(lines) > 3400
    for text in (prose + lines, lines + prose):
        m = dict(zip([p.split()[0] for p in C.MEASURES.split(", ")], C.measure(text, z, whole=())))
        assert (m["base_failed"], m["n_chunks"], m["low_chunks"], m["kept"]) == (False, 2, 1, False)
    whole = C.measure(prose, z)
    assert whole[8:] == (1, 0, 0, True) and C.measure(prose + prose[:50], z)[-1]


def test_every_row_is_measured(spark):
    got = C.compression_bands(documents(spark)).select("doc_id", "text", "quality.*").collect()
    assert len(got) == len(DOCS)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(r.text or "")
    assert C.compression_bands(empty(spark)).count() == 0


def plain_judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


URLS = [
    None, "", "no scheme", "http://Example.COM/en/x?q#f", "http://www.example.com/en/1", "http://a.www.example.com/en/",
    "http://example.com", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/fr/", "http://net/es/", "http://x.org/a/",
    "https://www.x.org/a.html?utm=1#top", "http://m.x.org:80/a/index.html", "http://x.org/b", "://", "http:///p", "http://x.org/a#://y",
]


def test_rules_and_exact_list_behind_the_filter(spark):
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(URLS)] + [(2, URLS[2], "v")], "page_id long, url string, verdict string")
    listed = spark.createDataFrame([("http://x.org/a",), ("http://x.org/a",), (None,)], "url string")
    # one block makes nearly every URL a possible hit; the join must sort them out
    for blocks in (1, 1 << 16):
        got = U.judge_urls(pages, listed, URL_RULES, blocks=blocks)
        assert got.columns == ["page_id", "host", "path", "rule", "listed", "verdict"]
        table = rows(got, "page_id")
        assert len(table) == len(URLS) + 1
        for i, host, path, rule, hit, verdict in table:
            assert (host, path, rule) == plain_judge(URLS[i])[:3]
            want = plain_judge(URLS[i])[3] or ("block" if i in (11, 12, 13, 17) else "allow")
            assert (verdict, hit) == (want, i in (11, 12, 13, 17))
    nothing = U.judge_urls(pages, listed.limit(0), URL_RULES)
    assert nothing.where("listed").count() == 0 and nothing.count() == len(table)
    assert U.judge_urls(pages.limit(0), listed, URL_RULES).count() == 0
