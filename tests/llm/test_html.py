"""Main text of pages: markup cases, templates found by counts alone, and the given pages."""

import html
import re
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from kelpfit.llm import html_text, queries

SCHEMA = "page_id long, url string, html string"


def texts(spark, pages, **options):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], SCHEMA)
    return {r.page_id: r for r in html_text.main_text(df, **options).collect()}


class Article(HTMLParser):
    """A plainer reading of the given pages: blocks of the article element."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.depth, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.blocks[-1] += " " if tag == "br" else ""
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.depth:
            self.blocks[-1] += data

    def handle_entityref(self, name):
        raise AssertionError("texts are decoded below")


def by_parser(source):
    reader = Article()
    # references are hidden from the parser and decoded at the end
    reader.feed((source or "").replace("&", ""))
    reader.close()
    blocks = [" ".join(html.unescape(b.replace("", "&")).split()) for b in reader.blocks]
    return " ".join(b for b in blocks if b)


def test_given_pages(spark, folder):
    want = {r["page_id"]: by_parser(r["html"]) for r in pq.read_table(f"{folder}/pages.parquet").to_pylist()}
    got = {r.page_id: r for r in queries.QUERIES["op12_html_text"](spark, folder).collect()}
    assert {k: r.text for k, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


@pytest.mark.parametrize(("source", "want"), [
    ("<p>a<b>b<br>c<p>d &amp &quot; x&#39;s &eacute;&nbsp; y", "ab c d & \" x's é y"),
    ("<article><h1>T &am</h1><p>foo<span class='ad'>zzz</span>bar<br><p>x</article><footer>f", "T &am foobar x"),
    ("<b><p>te</b>xt</p>", "text"), ("<", "<"), ("<a", ""), ("a < b <!-- x", "a < b"), ("", ""),
    ("<script>var t='</p>';</script><p>x", "x"), ("<style>p{}</style>y<script>z", "y"),
    ("<html><head><title>t</title></head>one<table><tr><td>1<td>2<tr><td>3</table>", "one 1 2 3"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a b c"),
    ("<main><h1>H</h1><div class=\"entry\">x <i>y</i>z</div><div class='comment-list'><article>no</article></div></main>",
     "H x yz"),
    ("<div class='with-sidebar'><article><header><h1>H</h1></header><p>x<footer>by</footer></article></div>", "H x"),
    ("<div id=cookieNotice>c</div><form>f<input></form><p>x<button>b</button></p><aside>s</aside><p hidden>h</p>", "x"),
    ("<p title=\"a>b\">x</p><p title='open>y</p>", "x y"),
])
def test_markup(source, want):
    _, blocks = html_text.parsed_page(source)
    assert " ".join(b["text"] for b in blocks if not b["marked"] and not b["outside"]) == want


def test_templates_are_found_by_counts_alone(spark):
    def page(i, extra=""):
        menu = "<div><div>Home</div><div>Shop now</div></div>"
        return f"<body>{menu}<div><div>Story {chr(97 + i)} begins here</div>{extra}</div><div>Made by {i} hands</div></body>"

    site = [("http://a.example/x", page(i)) for i in range(12)]
    small = [(f"http://b{i}.example/", page(i)) for i in range(3)]
    got = texts(spark, site + small)
    assert [got[i].text for i in range(12)] == [f"Story {chr(97 + i)} begins here" for i in range(12)]
    assert all(got[i].n_template == 3 and got[i].n_marked == 0 for i in range(12))
    # a host of one page has nothing to compare with
    assert got[12].text == "Home Shop now Story a begins here Made by 0 hands"


def test_copies_and_shared_passages_stay(spark):
    passage = "<p>" + " ".join(f"w{i}" for i in range(60)) + "</p>"
    shared = [("//h.example", f"<nav><a href=/>n</a></nav><article><p>own {chr(97 + i)}</p><p>a line</p>{passage}</article>")
              for i in range(20)]
    plain = [("//i.example", f"<div>{passage if i < 8 else ''}<p>own {'xyz'[i % 3] * (i + 1)}</p></div>") for i in range(20)]
    copies = [("//j.example", "<div><h2>Title</h2><p>Body of it</p></div>") for _ in range(20)]
    got = texts(spark, shared + plain + copies)
    long = " ".join(f"w{i}" for i in range(60))
    assert [got[i].text for i in range(20)] == [f"own {chr(97 + i)} a line {long}" for i in range(20)]
    assert all(long in got[i].text for i in range(20, 28))
    assert {got[i].text for i in range(40, 60)} == {"Title Body of it"}


def test_nulls_repeats_and_extra_columns(spark):
    long = "<p>" + "word " * 200_000 + "</p>"
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "http://H.example:80/p", "<p>a", "y"),
            (2, "not a url", "", "z"), (3, "https://u@h.example/", long, "w"), (4, "", "<p>" * 5000 + "deep", "v")]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], SCHEMA + ", text string, host string, blocks int")
    got = sorted(html_text.main_text(df).collect(), key=str)
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in got if r.page_id) == [
        (1, None, "", 0), (1, None, "", 0), (2, "not a url", "", 0),
        (3, "https://u@h.example/", ("word " * 200_000).strip(), 999_999), (4, "", "deep", 4)]
    assert [(r.url, r.text) for r in got if r.page_id is None] == [("http://H.example:80/p", "a")]
    hosts = {
        r["url"]: r["h"] for r in df.select("url", html_text.host_of().alias("h")).collect()}
    assert hosts["http://H.example:80/p"] == hosts["https://u@h.example/"] == "h.example" and hosts[None] == ""


def test_empty_table(spark):
    assert html_text.main_text(spark.createDataFrame([], SCHEMA)).collect() == []
