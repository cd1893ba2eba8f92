import collections
import html
import random
import re

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from skytally.llm import boilerplate, markup, queries
from skytally.llm.common import table

WORDS = [a + b for a in ("ka", "lo", "mi", "tu", "ser", "van", "dol", "pre") for b in ("n", "ra", "s", "te", "ble", "x", "ing", "o")]


def article(rng, n=3):
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(15, 60))) for _ in range(n)]


def test_query_finds_the_article_of_every_page(spark):
    """The pages of the tables have one article element each."""
    found = {r["page_id"]: r for r in queries.QUERIES["op13_article"](spark, SMALL).collect()}
    pages = table(spark, SMALL, "pages").collect()
    assert len(found) == len(pages)
    for row in pages:
        inner = re.search(r"<article>(.*)</article>", row["html"], re.DOTALL)[1]
        texts = [html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", inner)]
        expected = "\n\n".join(" ".join(t.split()) for t in texts if t.strip())
        got = found[row["page_id"]]
        assert (got["text"], got["n_chars"], got["url"]) == (expected, len(expected), row["url"])


def texts(page):
    return [b.text for b in markup.blocks(page) if not b.around]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("a < b &amp; c &lt;d&gt; &eacute;&#233;&#xe9; &unknown;", ["a < b & c <d> ééé &unknown;"]),
        ("<p>one<p>two</b></i>three<div>four</div>five", ["one", "twothree", "four", "five"]),
        ("<p><b>one.<br><p>two", ["one.", "two"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<p>a<b>b</b>c<br>d<img alt=x>e</p>", ["abc de"]),
        ("<script>if (a</b>) '</p>'</script>x<style>p{}</style><noscript></noscript>", ["x"]),
        ("<SCRIPT>x", []),
        ("a<!-- no <p> --> b<!-->c<!doctype x>d<!-- never ends", ["a bcd"]),
        ("a<p title='1 > 0' hidden>b</p>c", ["a", "c"]),
        ("a <b class=x", ["a"]),
        ("<nav>n</nav><header>h<h1>H</h1></header><aside>s</aside><footer>f</footer>x", ["x"]),
        ("<article><header><h1>Title</h1>by me</header><p>x</p><footer>f</footer></article>", ["Title", "x"]),
        ("<div class='cookie-notice'>c</div><div class=hasSidebar>x<div id=sidebarLeft>s</div></div>", ["x"]),
        ("<div class='has-sidebar'>x</div><section id=comments><article>me too</article></section>", ["x"]),
        ("<form>f<input><button>b</button></form><select><option>o</select><textarea><p>t</textarea>x", ["x"]),
        ("<div role=navigation>n</div><div style='display: none'>h</div>x", ["x"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("</p></div></br>x</span>y", ["xy"]),
        ("\xa0x y\xa0", ["x y"]),
    ],
)
def test_blocks(page, expected):
    assert texts(page) == expected


def test_deep_and_broken_markup_ends():
    assert texts("<div>" * 50_000 + "x") == ["x"]
    assert texts("<p><b>" * 20_000 + "x")[-1] == "x"
    assert texts("<" * 100_000) == ["<" * 100_000]
    assert texts("<a " * 50_000) == []
    assert texts("<a b='" * 20_000) == []


def plain_repeats(pages, depth):
    """The figures of ``repeats`` by counting every string."""
    on = collections.defaultdict(lambda: collections.defaultdict(set))
    for number, segments in enumerate(pages):
        for place, tokens in segments:
            runs = [tuple(tokens[i : i + depth]) for i in range(len(tokens) - depth + 1)] or [(*tokens, None)]
            for run in runs if tokens else []:
                on[place][run].add(number)
    return {
        place: (len(found), sum(len(p) > 1 for p in found.values()), sum(len(p) for p in found.values())) for place, found in on.items()
    }


@pytest.mark.parametrize("seed", range(6))
def test_suffix_classes_equal_counting(seed):
    rng = random.Random(seed)
    pages = []
    for _ in range(rng.randint(1, 12)):
        segments = [(rng.choice([4, 5, 8]), [rng.randint(1, 3) for _ in range(rng.randint(1, 14))]) for _ in range(rng.randint(0, 5))]
        pages.append(segments)
    arrays = [
        (i, np.array([p for p, _ in s], np.int64), np.array([len(t) for _, t in s], np.int32), np.array([x for _, t in s for x in t], np.uint32))
        for i, s in enumerate(pages)
    ]
    for depth in (1, 2, 4, 8):
        assert boilerplate.repeats(arrays, depth) == plain_repeats(pages, depth)


def site(rng, n, host="http://Site.example:80"):
    """Pages without article elements: menu, greeting and imprint are told from the text by repetition alone."""
    greetings = [" ".join(rng.choice(WORDS) for _ in range(12)) for _ in range(5)]
    rows = []
    for i in range(n):
        body = article(rng)
        page = (
            f"<body><div class=top><a>Start</a> <a>News</a> <a>Contact us</a></div><div class=hello>{rng.choice(greetings)}</div>"
            f"<div class=text>{''.join(f'<p>{b}</p>' for b in body)}</div><div class=end>All rights reserved by the house of {host[-9:]}</div>"
        )
        rows.append((i, f"{host}/p{i}?x=1", page, "\n\n".join(body)))
    return rows


SCHEMA = "page_id long, url string, html string, expected string"


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("clash")).withColumn("host", F.lit("clash"))
    found = {r["page_id"]: r for r in boilerplate.extract(df).collect()}
    for key, url, _, expected in rows:
        assert (found[key]["text"], found[key]["url"], found[key]["n_chars"]) == (expected, url, len(expected))
    return found


@pytest.mark.parametrize("chunk", [boilerplate.CHUNK_CHARS, 20_000])
def test_repeated_places_go_and_shared_passages_stay(spark, monkeypatch, chunk):
    monkeypatch.setattr(boilerplate, "CHUNK_CHARS", chunk)
    rng = random.Random(1)
    rows = site(rng, 90)
    # A third of the pages are copies of one article; two others share a passage.
    rows[:30] = [(key, url, rows[0][2], rows[0][3]) for key, url, _, _ in rows[:30]]
    shared = rows[40][3].split("\n\n")[1]
    for i in (50, 51):
        key, url, page, text = rows[i]
        first = text.split("\n\n")[0]
        rows[i] = (key, url, page.replace(first, shared), text.replace(first, shared))
    # A small host of the same make is judged by the other's places.
    rows += [(1000 + i, url, page, text) for i, url, page, text in site(rng, 2, "https://tiny.example")]
    found = check(spark, rows)
    assert all(r["n_repeated"] > 50 for r in found.values())


def test_a_small_site_alone_keeps_what_the_markup_does_not_name(spark):
    rows = site(random.Random(2), 3)
    df = spark.createDataFrame(rows, SCHEMA)
    for r in boilerplate.extract(df).collect():
        assert r["n_repeated"] == 0 and "All rights reserved" in r["text"]


def test_odd_rows(spark):
    rows = [
        (1, None, "<article><p>x</p></article>", "x"),
        (2, "no url", None, ""),
        (3, "", "", ""),
        (None, "http://a/", "<main><p>in</p></main><p>out</p>", "in"),
        (5, "http://a/", "<main><p>in</p><article>art</article></main>", "art"),
        (6, "http://a/", "<nav>only a menu</nav>", ""),
        (7, "http://a/", "<article>" + "long " * 300_000 + "</article>", ("long " * 300_000).strip()),
    ]
    check(spark, rows)
    twice = spark.createDataFrame([rows[0], rows[0]], SCHEMA)
    assert boilerplate.extract(twice).count() == 2
    assert boilerplate.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_figures_do_not_depend_on_the_chunks(spark, monkeypatch):
    """Half of a place's strings are on two pages or three, which chunks part; a site of few pages has a copy with a place of its own."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        text, own = article(rng, 1)[0], article(rng, 1)[0]
        shared = f"offer number {i // 3} of this house is open until the last day of month {i // 3}"
        rows.append((f"http://big.example/{i}", f"<div class=text>{text}</div><div class=offer>{shared}</div><div class=end>the same end</div>{own}"))
    for i in range(3):
        extra = "<div class=end>the same end</div>" * (i == 2)
        rows.append((f"http://tiny.example/{i}", f"<div class=text>{' '.join(WORDS[:40])}</div><div class=offer>none {i}</div>{extra}"))
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "page_id long, url string, html string")
    pages = frame.select(F.xxhash64(boilerplate.host_of(F.col("url"))).alias("host"), "html")
    results = []
    for chunk, small, bucket in ((boilerplate.CHUNK_CHARS, boilerplate.SMALL, 8), (3_000, boilerplate.SMALL, 8), (1_000, 0, 2)):
        monkeypatch.setattr(boilerplate, "CHUNK_CHARS", chunk)
        monkeypatch.setattr(boilerplate, "SMALL", small)
        monkeypatch.setattr(boilerplate, "BUCKET_CHUNKS", bucket)
        found = boilerplate.extract(frame).select("page_id", "text", "n_repeated").collect()
        places = {r["host"]: sorted(r["places"]) for r in boilerplate.repeated_places(pages).collect()}
        results.append((sorted(map(tuple, found)), places))
    assert results[0] == results[1] == results[2]
    texts_found = {r[0]: r[1] for r in results[0][0]}
    assert not any("offer number" in texts_found[i] or "same end" in texts_found[i] for i in range(60))
    assert not any("same end" in texts_found[i] for i in (60, 61, 62)) and not any("none" in texts_found[i] for i in (60, 61, 62))


def test_elements_are_remembered(monkeypatch):
    """A second page with the same elements asks for none of them again, and gives the same blocks."""
    page = '<html><body><nav class="menu top"><ul><li>a<li>b</ul></nav><article id="x"><p>one<img alt="a>b"> two<p>three</article></body></html>'
    first, asked = markup.blocks(page), []
    monkeypatch.setattr(markup, "_child", lambda *a: asked.append(a))
    assert markup.blocks(page) == first and not asked
    assert [(b.text, b.around) for b in first] == [("a", True), ("b", True), ("one two", False), ("three", False)]
