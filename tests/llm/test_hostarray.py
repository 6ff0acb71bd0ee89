import html
import random
import re

import pytest

from tracewell.llm import hostarray as ha
from tracewell.llm.queries import op8_html_extraction

PAGES = [
    ("<article><h1>T &amp; x</h1><p>a\n b<b>c</b><br>d</article><footer>f</footer>", "T & x a bc d"),
    ("<body><nav>n</nav><main><p>one<p>two <a href='>'>link</a></main><div class='ad'>ad</div></body>", "one two link"),
    ("<article><header><h1>Title</h1></header><p>x</p><div class='ad-box'>buy</div><aside>s</aside><form>f<input></form>"
     "<section id='comments'><article class='comment'>no</article></section><p>y</p><footer>by</footer></article>", "Title x y"),
    ("<div class='cookie-notice'>c</div><div id=sidebar><ul><li>s</ul></div><p>kept &eacute;&nbsp;&#x41;</p><!-- <p>no --><script>'</p>'</script>",
     "kept é A"),
    ("<html><head><title>t</title><style>p{}</style></head><body><p hidden>h</p><div style='display: none'>d</div>text", "text"),
    ("<article><p>a < b and c > d</p><noscript>n</noscript><table><tr><td>1<td>2</table></article>", "a < b and c > d 1 2"),
    ("<div role=navigation>x</div><div role='main'>m <div>n</div></div>after", "m n"),
    ("<article>open <b>bold", "open bold"), ("plain", "plain"), ("", ""), (None, ""), ("<nav>only</nav>", ""), ("<<>&lt;p&gt;", "<<><p>"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_markup(page, text):
    assert " ".join(ha.blocks(page or "")[0]) == text


def brute(pages):
    """Every string of LEAST tokens of every page, counted over the host's distinct streams."""
    streams, out = {}, []
    for _, url, page in pages:
        found, marked = ha.blocks(page or "")
        if not marked and found:
            streams.setdefault((url or "").split("/")[2:3] and url.split("/")[2] or "", set()).add(" ".join(found))
    for key, url, page in pages:
        found, marked = ha.blocks(page or "")
        text = " ".join(found)
        if not marked and found:
            own, words = streams[(url or "").split("/")[2:3] and url.split("/")[2] or ""], text.split(" ")
            grams = [{tuple(s.split(" ")[i:i + ha.LEAST]) for i in range(len(s.split(" ")) - ha.LEAST + 1)} for s in own]
            gone = set()
            for i in range(len(words) - ha.LEAST + 1):
                n = sum(tuple(words[i:i + ha.LEAST]) in g for g in grams)
                if n >= ha.PAGES and n >= ha.SHARE * len(own):
                    gone |= set(range(i, i + ha.LEAST))
            text = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, url, text))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [500_000, 100])
def test_boilerplate_of_a_host(rows, monkeypatch, shard):
    monkeypatch.setattr(ha, "SHARD", shard)
    random.seed(shard)
    bars = [" ".join(random.choices("abcdefgh", k=12)) for _ in range(3)]
    pages = []
    for i in range(60):
        body = " ".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(0, 30)))
        pages.append((i, f"http://h{i % 3}.org/{i}", f"<p>{bars[i % 3]}</p><p>{body}</p><p>{random.choice(bars)} end</p>"))
    pages += [(100, "http://h0.org/copy", pages[0][2]), (None, None, pages[1][2]), (101, "http://h0.org/a", f"<article>{bars[0]}</article>"),
              (102, "http://h1.org/b", None), (102, "http://h1.org/b", ""), (103, "http://big.org/", "<p>" + "word " * 1_000 + "</p>")]
    df = rows(pages, "page_id long, url string, html string").selectExpr("*", "1 AS key", "2 AS host", "3 AS text")
    got = ha.main_text(df, "page_id", "url", "html").collect()
    assert sorted(((r["key"], r["url"], r["text"]) for r in got), key=str) == brute(pages)
    unique = [r for r in got if r["key"] == 101]
    assert unique[0]["text"] == bars[0]  # an article keeps what the host repeats


@pytest.mark.parametrize(("page", "text"), [
    ("<main class='with-sidebar'><p>one</p></main>", "one"), ("<article class='post no-comments'>two</article>after", "two"),
    ("<div class='page has-sidebar'><article>three</article></div>", "three"), ("<article id='social-policy'>four</article>", "four"),
    ("<article><div class='entry-header'><h1>T</h1></div><p>x</p></article>", "T x"), ("<article><h1 class='post-header'>T</h1>x</article>", "T x"),
    ("<article><div class='header'><h2 class='banner'>T</h2></div>x</article>", "T x"), ("<div role='main' class='share'>five</div>", "five"),
    ("<div class='overlay'><div>a</div><article class='search'>six</article></div>", "six"), ("<div class='overlay'><p>no</p></div>seven", "seven"),
    ("<div class='sidebar'><article>no</article></div><article>eight</article>", "eight"),
    ("<article>nine<section class='post-comments'><article>no</article></section><article class='comment'>no</article></article>", "nine"),
    ("<div class='social-share'>no</div><div class='siteFooter'>no</div><div class='share-price'>ten</div>", "ten"),
])
def test_class_words(page, text):
    assert " ".join(ha.blocks(page)[0]) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<article>a <svg class='icon'/>b<p>c</p><svg><text>no</text></svg>d</article>", "a b c d"), ("<article>a <math/>b</article>", "a b"),
    ("<article>a<object data=x><p>b</p>c", "a b c"), ("<article>a<video src=x><p>b</p></article>", "a b"), ("<article>a<select><p>b", "a b"),
    ("<article>a <svg>no<svg>no</svg>no</svg>b</article>", "a b"), ("<article>a<object>no<object>no</object>no</object>b</article>", "a b"),
    ("<article>a <svg>no<svg/>no</svg>b <svg><!-- <svg> -->no</svg>c</article>", "a b c"), ("<article>a<iframe src=x/><p>b</p><iframe>no</iframe>c", "a b c"),
    ("<article>a<script>'<svg>'</script>b <svg>no</svg>c<style>no", "a b c"),
])
def test_elements_without_text(page, text):
    assert " ".join(ha.blocks(page)[0]) == text


def test_no_rows(rows):
    assert ha.main_text(rows([], "page_id long, url string, html string"), "page_id", "url", "html").count() == 0


def test_articles_of_the_table(spark, sf_dir):
    """All pages there mark their article."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in op8_html_extraction(spark, sf_dir).collect()}
    assert got.keys() == pages.keys()
    for key, page in pages.items():
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert got[key] == (text, len(text))


@pytest.mark.parametrize("shard", [500_000, 100])
def test_notices_inside_articles(rows, monkeypatch, shard):
    """What a host repeats inside its marked articles is found by their suffix arrays."""
    monkeypatch.setattr(ha, "SHARD", shard)
    random.seed(1)
    notice = "share this story with all of your friends today"
    bodies = [" ".join(f"w{random.randrange(10**6)}" for _ in range(20)) for _ in range(40)]
    pages = [(i, f"http://h{i % 2}.org/{i}", f"<article><p>{b}</p><p>{notice}</p></article>") for i, b in enumerate(bodies)]
    pages += [(50, "http://h2.org/a", pages[0][2]), (51, "http://h2.org/b", pages[0][2]), (52, "http://h2.org/c", pages[0][2])]
    pages += [(60 + i, f"http://h3.org/{i}", f"<article><p>{bodies[0]}</p><p>version {i}</p></article>") for i in range(4)]
    got = {r["key"]: r["text"] for r in ha.main_text(rows(pages, "page_id long, url string, html string"), "page_id", "url", "html").collect()}
    assert [got[i] for i in range(40)] == bodies
    assert all(got[i] == f"{bodies[0]} {notice}" for i in (50, 51, 52))  # copies count as one page
    assert all(got[60 + i] == f"{bodies[0]} version {i}" for i in range(4))  # revisions stay whole


def test_a_word_is_hashed_once(monkeypatch):
    real, calls = ha.hashlib.blake2b, []
    monkeypatch.setattr(ha.hashlib, "blake2b", lambda *a, **k: calls.append(a) or real(*a, **k))
    texts = [f"menu of the site with links to all pages own{i} own{i} end" for i in range(5)]
    table = ha.pa.table({"key": list(range(5)), "url": ["u"] * 5, "marked": [False] * 5, "text": texts})
    assert ha.whole_host(table).column("text").to_pylist() == [f"own{i} own{i} end" for i in range(5)]
    assert len(calls) == len({w for t in texts for w in t.split(" ")})


def test_counts_of_shards_decide(rows):
    """Shards tell all strings in half of SHARE of their streams; only what their bounds leave open is counted again."""
    schema = "host string, marked boolean, string long, streams long, most long"
    told = [("h", False, None, 100, 4), ("h", False, None, 100, 4), ("h", False, 1, 12, 4), ("h", False, 1, 9, 4),
            ("h", False, 2, 11, 4), ("h", False, 2, 7, 4), ("h", False, 3, 17, 4), ("h", False, 4, 12, 4)]
    got = {r["string"]: r["sure"] for r in ha.judged(rows(told, schema)).collect()}
    assert got == {1: True, 3: False}  # 2 is in 18 of 200 streams, 4 in 16 at most, 3 in 17 to 21


def test_packed_rows_are_small_and_whole():
    texts = [f"the same menu of the same site over and over again {i}" for i in range(500)]
    batch = ha.pack({("h", True, 3): [(i, None, t) for i, t in enumerate(texts)], (None, False, 0): [(1, "u", "é")]}, ha.pa.int64())
    table = ha.pa.Table.from_batches([batch])
    got = ha.unpack(table.slice(0, 1), ha.pa.int64())
    assert got.column("text").to_pylist() == texts and got.column("key").to_pylist() == list(range(500)) and set(got.column("marked").to_pylist()) == {True}
    assert ha.unpack(table.slice(1), ha.pa.int64()).to_pylist() == [{"key": 1, "url": "u", "text": "é", "marked": False}]
    assert ha.unpack(table.slice(2), ha.pa.int64()).num_rows == 0
    assert len(batch.column("rows")[0].as_py()) < sum(map(len, texts)) / 4
