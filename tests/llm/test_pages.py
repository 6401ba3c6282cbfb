from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest

from lodgeframe.llm import htmlmain, warc
from lodgeframe.llm.htmltree import main_text, mark, parse
from lodgeframe.llm.shards import open_fs
from lodgeframe.session import scratch_path

MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a>About</a></ul></nav>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a&nbsp; b\n c<br>d<p>e</p>", "a b c d\ne"),
        (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{MENU}"
         "<article><h1>H</h1><p><b>one<br><p>two <i>t</i>hree</p></article><footer>&copy; x</footer>", "H\none\ntwo three"),
        ("<body><header>x</header><main><h2>T</h2>loose<div class='ad-box'>n</div><ul><li>1<li>2</ul>"
         "<table><tr><td>q<td>w</table><form>f</form><div id=comments><article>cc</article></div></main>out", "T\nloose\n1\n2\nq\nw"),
        ("<article><p>kept</p><article class=comment><p>said</p></article><aside>s</aside><!-- <p>c</p> --></article>", "kept"),
        ("<article><p>cut of", "cut of"),
        ("<article><p>a</p><p cla", "a"),
        ("<article><header><h1>own title</h1></header><p title='a > b'>x &lt; y</article>", "own title\nx < y"),
        ("<div hidden>h</div><div role=navigation>n</div><div style='display: none'>s</div><p>seen</p>", "seen"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ],
)
def test_main_text(page, text):
    assert main_text(parse(page)) == text


def test_subtrees_outside_the_article_are_hashed():
    one, two = parse(f"<body><div>{MENU}</div><article>A</article>"), parse(f"<p>x</p>{MENU}<article><nav>A</nav></article>")
    a, b = set(mark(one)), set(mark(two))
    assert len(a & b) == 6 and len(b - a) == 1  # the menu and its parts; the paragraph


def pages_of(spark):
    rows = []
    for i in range(40):
        template = "<div class=x><p>Welcome to our site</p><p>Call us</p></div>"
        rows.append((i, f"http://big.example/{i}", f"<body>{template}<div><p>Body {i}</p></div><span>Imprint</span></body>"))
    rows += [(50 + i, f"http://small{i}.example/", "<body><div class=x><p>Welcome to our site</p></div><p>own</p>") for i in range(6)]
    rows += [(60, None, "<p>no host</p>"), (61, "http://big.example/", None), (61, "http://big.example/", None), (None, "x", "")]
    return spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, text int").repartition(4)


def test_templates_of_a_host_go(spark):
    got = htmlmain.extract(pages_of(spark))
    assert got.columns == ["page_id", "url", "text"]
    table = [tuple(r) for r in got.collect()]
    assert len(table) == 50
    text = {k: t for k, _, t in table}
    assert all(text[i] == f"Body {i}" for i in range(40))
    assert all(text[50 + i] == "Welcome to our site\nown" for i in range(6))
    assert text[60] == "no host" and text[61] == "" and text[None] == ""
    assert htmlmain.extract(pages_of(spark).limit(0)).count() == 0


@pytest.mark.parametrize("main", ["article", "main"])
def test_wrappers_of_the_article_are_no_template(spark, main):
    head, foot = "<div class=top><p>Our site</p></div>", "<div><p>Imprint and contact</p></div>"
    page = "<div id=page>{}<div id=content><div><{m}><p>Body {}</p></{m}></div></div>{}</div>"
    rows = [(i, f"http://wrapped.example/{i}", page.format(head, i, foot, m=main)) for i in range(12)]
    got = htmlmain.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Body {i}" for i in range(12)}
    tree = parse(rows[0][2])
    assert len(mark(tree)) == 4  # both constant boxes and their paragraphs, none of the wrappers


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    notice = "<div class=x><p>Section closed for repairs</p></div>"
    rows = [(i, "http://hot.example/", f"<body>{notice if i < 5 else ''}<div><p>Body {i}</p></div>") for i in range(2000)]
    rows += [(2000 + i, f"http://hot.example/copy{i}", "<body><p>One page, many times</p>") for i in range(40)]
    got = htmlmain.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    text = {r.page_id: r.text for r in got}
    assert all(text[i] == f"Body {i}" for i in range(2000))
    assert all(text[2000 + i] == "One page, many times" for i in range(40)) and len(got) == 2040


def test_boxes_in_many_different_articles_go(spark):
    box = "<div class=x><p>Read all of our stories every single day</p></div>"
    own = lambda i: " ".join(f"w{i * 31 + k * k}" for k in range(40))
    page = "<body><article><h2>Background</h2><p>{}</p><p>Yes he said</p>{}<p>And <b>so on</b></p></article></body>"
    rows = [(i, "http://boxes.example/", page.format(own(i), box)) for i in range(30)]
    # near copies of one article share nearly everything, and quotations stand in few articles
    rows += [(100 + i, "http://copies.example/", page.format(own(1) + f" copy{i}", box)) for i in range(60)]
    rows += [(200 + i, "http://quotes.example/", page.format(own(i), box if i < 6 else "")) for i in range(30)]
    # a short line of prose stands in fewer than half of the articles
    rows += [(300 + i, "http://prose.example/", f"<article><p>{own(i)}</p>{'<p>Yes he said</p>' if i < 25 else ''}</article>") for i in range(80)]
    got = htmlmain.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()
    text, said = {r.page_id: r.text for r in got}, "Read all of our stories every single day"
    assert all(text[i] == f"Background\n{own(i)}" for i in range(30))
    assert all(text[100 + i] == f"Background\n{own(1)} copy{i}\nYes he said\n{said}\nAnd so on" for i in range(60))
    assert all((said in text[200 + i]) == (i < 6) for i in range(30))
    assert all(("Yes he said" in text[300 + i]) == (i < 25) for i in range(80))


def test_shared_prose_of_articles_stays(spark):
    own = lambda i: " ".join(f"w{i * 37 + k * k}" for k in range(40))
    said, sold = "All of them have this line of prose", "All of them have this line to sell"
    page = "<article><p>{}</p><p>{}</p><p class=x>{}</p><p>end {}</p></article>"
    rows = [(i, "http://prose.example/", page.format(own(i), said, sold, i)) for i in range(40)]
    got = htmlmain.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert {r.page_id: r.text for r in got} == {i: f"{own(i)}\n{said}\nend {i}" for i in range(40)}


def test_counts_of_subtrees(spark):
    """Templates against counts in plain dictionaries, on random sets of subtrees with copies of pages."""
    rng = random.Random(5)
    rows = []
    for page in range(400):
        site, article = rng.choice([1, 1, 1, 2, 3]), rng.choice([0, rng.randrange(1, 150)])
        boxes = rng.sample(range(100, 112), rng.randrange(4)) if article else []
        brief = rng.sample(range(200, 206), rng.randrange(3)) if article else []
        rows.append((site, page, rng.sample(range(1, 30), rng.randrange(6)), article, article % 40, boxes, brief))
    rows += [(1, page, [1, 2], 0, 0, [], []) for page in [900] * 9]
    # equal articles have equal boxes
    known = {}
    rows = [(*r[:4], r[4], *known.setdefault((r[0], r[3]), (r[5], r[6]))) for r in rows]
    schema = "site long, page long, hashes array<long>, article long, sketch long, boxes array<long>, brief array<long>"
    df = spark.createDataFrame(rows, schema).repartition(4)
    seen = {}
    for site, page, hashes, *_ in {(r[0], r[1]): r for r in rows}.values():
        for h in hashes:
            seen.setdefault((site, h), set()).add(page)
    want = {k for k, pages in seen.items() if len(pages) >= 5}
    outer = htmlmain.site_templates(df, 5)
    assert {tuple(r) for r in outer.collect()} == want and want

    of, articles = {}, {}
    for site, _, _, article, sketch, boxes, brief in rows:
        if article:
            articles.setdefault(site, set()).add(article)
            for h in [*boxes, *brief]:
                of.setdefault((site, h), {})[article] = sketch
    inner = {
        (site, h)
        for (site, h), found in of.items()
        if len(found) >= 8 and 2 * len(set(found.values())) >= len(found) and (h < 200 or 2 * len(found) >= len(articles[site]))
    }
    templates = htmlmain.article_templates(df, 8)
    assert {tuple(r) for r in templates.collect()} == inner and inner

    all_of = want | inner
    gone = {}
    for site, page, hashes, article, _, boxes, brief in rows:
        own = {h for h in [*([] if article else hashes), *boxes, *brief] if (site, h) in all_of}
        if own:
            gone[site, page] = own
    got = htmlmain.removed_subtrees(df, outer.union(templates)).collect()
    assert {(r.site, r.page): set(r.removed) for r in got} == gone and len(got) == len(gone)


def archive_rows(spark):
    rows = [(i, f"http://x/{i}\r\nForged: 1", f"page {i % 7} é" * (i % 5)) for i in range(60)]
    rows += [(3, "again", "page 3 é" * 3), (70, None, None), (71, "u", ""), (None, "u", "page 1 é"), (72, "u", "z" * 300_000)]
    return spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string")


def plain_archive(rows, least):
    first = {}
    for key, _, html, _ in rows:
        if key is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", key), key)
    out, seen = [], set()
    for key, _, html, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (html or "").encode()
        head = first.get(html or "")
        revisit = key is not None and head is not None and (head < key or (key, data) in seen)
        seen.add((key, data))
        mark = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), mark, "revisit" if revisit else "response", head if revisit else None))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, r[3], r[2])


@pytest.mark.parametrize("least", [0, 10])
def test_archives(spark, least):
    df = archive_rows(spark)
    files = []
    for parts in (1, 5):
        base = scratch_path(spark, "warc")
        manifest = warc.write_warc(df.repartition(parts), base, least_bytes=least, shard_bytes=1000, roll_bytes=600)
        got = [(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(manifest, base).collect()]
        assert sorted(got, key=key) == sorted(plain_archive(df.collect(), least), key=key)
        names = sorted(r.name for r in manifest.collect())
        fs, root = open_fs(base)
        files.append([(n, fs.open_input_stream(f"{root}/{n}", compression=None).read()) for n in names])
        assert fs.get_file_info(f"{root}/_tmp").type.name == "NotFound"
    assert files[0] == files[1] and len(files[0]) > 5  # the same bytes however the rows were dealt
    headers = [r.split(b"\r\n\r\n")[0] for _, data in files[0] for r in gzip.decompress(data).split(b"WARC/1.1\r\n")[1:]]
    assert not any(b"\r\nForged" in h for h in headers)


def test_damage_is_noticed(spark):
    record = warc._record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>")], b"body", 6)
    data = gzip.decompress(record)
    assert warc.parse(data)[1] == b"body"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"body", b"bodx"))
    base = scratch_path(spark, "warc")
    assert warc.read_warc(warc.write_warc(archive_rows(spark).limit(0), base), base).count() == 0
