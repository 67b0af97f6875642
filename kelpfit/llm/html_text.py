"""Main text of web pages, by removing what a site's pages have in common.

Every block element of a page gets a hash of its whole subtree: names, classes and
texts, with digits alike. Spark counts, per host, on how many pages a hash occurs and
below how many different parents; what recurs on many pages in many surroundings is
part of the site's template and is cut out with all that is below it. Copies of one
article do not make its paragraphs a template, since they keep their parent.

Counting needs pages. Where a host has too few, or a menu or advert differs from page
to page, the element's own name, role and class words say what it is. An element
that says it is the article (``article``, ``main``) is not judged by counts, so that a
passage which many articles quote stays in all of them; only its link lists are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpfit.llm.common import stored, text_of

#: A template part occurs on so many pages of its host at least, below as many parents ...
MIN_PAGES = 5
#: ... and on this share of them; prose of PROSE_WORDS words or more on PROSE_SHARE.
MIN_SHARE = 0.02
PROSE_WORDS = 50
PROSE_SHARE = 0.5
#: Characters of pages parsed before rows are handed on.
HELD_CHARS = 4_000_000

# Element names and words of class names, from the HTML standard and common usage.
BLOCKS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg".split())
CLOSES_P = BLOCKS - frozenset("body caption col colgroup html legend optgroup option tbody td tfoot th thead tr".split())
# an element of the first kind ends open ones of the second, up to one of the third
ENDED_BY = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
    "option": (("option",), ("select",)), "body": (("head",), ("html",)),
}
P_SCOPE = ("article", "section", "div", "td", "th", "li", "table", "button", "blockquote", "caption")
HEAD_ONLY = frozenset("base basefont bgsound link meta title style script noscript template head html".split())
MARKED = frozenset("nav footer aside form button select dialog menu search object audio video canvas".split())
MARKED_OUTSIDE_ARTICLE = frozenset(["header"])
MARKED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MARKED_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion popup modal overlay cookie cookies consent gdpr notice "
    "notices notification newsletter subscribe signup login share sharing social related recommended recommendations "
    "comment comments disqus respond pagination pager toolbar banner".split())
MARKED_WORDS_OUTSIDE_ARTICLE = frozenset(["header"])
NEGATED = frozenset(["has", "with", "no", "without"])

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|</[^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")


class _Element:
    """An open or closed element; only block elements take part in the tree of subtrees."""

    __slots__ = ("name", "parent", "marked", "main", "block", "inside", "link", "has_main", "parts", "n_words",
                 "n_linked", "key", "removable", "holder")

    def __init__(self, name: str, up: _Element | None, marked: bool, main: bool, block: bool):
        self.name, self.marked, self.main, self.block = name, marked, main, block
        # the innermost block element around it, and that element for what follows
        self.parent = up.holder if up else None
        self.holder = self if block else self.parent
        self.inside = main or bool(up and up.inside)
        self.link = name == "a" or bool(up and up.link)
        self.has_main, self.parts, self.n_words, self.n_linked, self.key, self.removable = False, [], 0, 0, 0, False


def _marked_by(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in MARKED or name in MARKED_OUTSIDE_ARTICLE and not in_article:
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in MARKED_ROLES or "hidden" in attributes:
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    for one in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _CLASS_WORD.findall(one)]
        if words and words[0] not in NEGATED and name != "body" and any(
                w in MARKED_WORDS or w in MARKED_WORDS_OUTSIDE_ARTICLE and not in_article for w in words):
            return True
    return False


class _Page:
    """One pass over the tags of a page."""

    def __init__(self):
        root = _Element("", None, False, False, True)
        self.open, self.done, self.pieces, self.linked = [root], [], [], 0
        self.blocks: list[tuple[_Element, str]] = []

    def text(self, raw: str) -> None:
        if self.open[-1].name == "head":
            if not raw.strip():
                return
            self.close("head")
        here = self.open[-1]
        if here.marked and not here.holder.marked:
            return  # an inline advert or button
        self.pieces.append(html.unescape(raw) if "&" in raw else raw)
        if here.link:
            self.linked += len(raw.split())

    def flush(self) -> None:
        """End the current block; its text belongs to the innermost open block element."""
        if not self.pieces:
            return
        words = "".join(self.pieces).split()
        if words:
            at, text = self.open[-1].holder, " ".join(words)
            self.blocks.append((at, text))
            at.parts.append(_DIGITS.sub("0", text).encode())
            at.n_words += len(words)
            at.n_linked += self.linked
        self.pieces, self.linked = [], 0

    def start(self, name: str, attributes: dict[str, str]) -> None:
        if self.open[-1].name == "head" and name not in HEAD_ONLY:
            self.close("head")
        if name in CLOSES_P:
            self._end(("p",), P_SCOPE)
        if name in ENDED_BY:
            self._end(*ENDED_BY[name])
        block = name in BLOCKS
        if block:
            self.flush()
        elif name == "br":
            self.pieces.append("\n")
        if name in VOID:
            return
        up = self.open[-1]
        marked = up.marked or _marked_by(name, attributes, up.inside)
        main = block and not marked and (name in ("article", "main") or attributes.get("role", "").lower() == "main")
        element = _Element(name, up, marked, main, block)
        if block:
            element.parts.append(f"{name} {attributes.get('class', '')}".encode())
        self.open.append(element)

    def _end(self, names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        """Close open elements of some names, up to the innermost of ``stops``."""
        low = max((i for i, e in enumerate(self.open) if e.name in stops), default=0)
        first = next((i for i in range(low + 1, len(self.open)) if self.open[i].name in names), len(self.open))
        while len(self.open) > first:
            self._pop()

    def close(self, name: str) -> None:
        if name == "br":
            self.pieces.append("\n")
        at = max((i for i, e in enumerate(self.open) if e.name == name and i), default=0)
        if not at:
            return
        if name not in BLOCKS and name != "head" and any(e.block for e in self.open[at:]):
            del self.open[at]  # the end of an inline element does not end the blocks in it
            return
        while len(self.open) > at:
            self._pop()

    def _pop(self) -> None:
        e = self.open[-1]
        if e.block:
            self.flush()
        self.open.pop()
        if e.block:
            e.key = _key(e)
            up = e.parent
            if e.n_words:
                up.parts.append(e.key.to_bytes(8, "little", signed=True))
            up.n_words += e.n_words
            up.n_linked += e.n_linked
            up.has_main |= e.main or e.has_main
            self.done.append(e)

    def finish(self) -> None:
        while len(self.open) > 1:
            self._pop()
        self.flush()
        self.open[0].key = _key(self.open[0])


def _key(e: _Element) -> int:
    return xxhash.xxh64_intdigest(b"\0".join(e.parts)) - (1 << 63)


def _removable(e: _Element) -> bool:
    """Whether counts may cut this subtree out: not the article, what it lies in, or prose in it."""
    if e.parent is None or e.name in ("html", "body") or not e.n_words or e.main or e.has_main:
        return False
    return not e.inside or e.marked or 2 * e.n_linked >= e.n_words


def parsed_page(source: str) -> tuple[list[dict], list[dict]]:
    """Removable subtrees and text blocks of one page.

    A subtree has its key (a hash), that of its parent, and whether it is long prose. A
    block has its text, whether its element is marked, and the keys of the removable
    subtrees it lies in. Of pages with an article only the blocks in it are given.
    """
    page, at = _Page(), 0
    for token in _TOKEN.finditer(source):
        if token.start() < at:
            continue
        if token.start() > at:
            page.text(source[at:token.start()])
        at = token.end()
        closing, name, rest = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            continue
        name = name.lower()
        if closing:
            page.close(name)
        elif name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else len(source)
        else:
            page.start(name, _attributes(rest))
    if at < len(source):
        page.text(source[at:])
    page.finish()
    subtrees = {}
    for e in page.done:
        e.removable = _removable(e)
        if e.removable:
            prose = e.n_words >= PROSE_WORDS and 2 * e.n_linked < e.n_words and not e.marked
            subtrees.setdefault(e.key, {"key": e.key, "parent": e.parent.key, "prose": prose})
    blocks, has_main = [], page.open[0].has_main
    for e, text in page.blocks:
        keys, up = [], e
        while up is not None:
            if up.removable:
                keys.append(up.key)
            up = up.parent
        blocks.append({"text": text, "marked": e.marked, "outside": has_main and not e.inside, "keys": keys})
    return list(subtrees.values()), blocks


def _attributes(rest: str) -> dict[str, str]:
    found = {}
    if rest and not rest.isspace() and rest != "/":
        for m in _ATTRIBUTE.finditer(rest):
            value = next((v for v in (m[2], m[3], m[4]) if v is not None), "")
            found.setdefault(m[1].lower(), html.unescape(value))
    return found


def host_of(url: str = "url"):
    """Host of an address in small letters; the empty string where there is none."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.regexp_extract(text_of(url), pattern, 1))


def parsed(pages: DataFrame) -> DataFrame:
    """Each page's host, removable subtrees and text blocks."""
    id_type = dict(pages.dtypes)["page_id"]
    subtree = pa.struct([("key", pa.int64()), ("parent", pa.int64()), ("prose", pa.bool_())])
    block = pa.struct([("text", pa.string()), ("marked", pa.bool_()), ("outside", pa.bool_()),
                       ("keys", pa.list_(pa.int64()))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = 0
            while low < batch.num_rows:
                high, chars, rows = low, 0, []
                while high < batch.num_rows and chars < HELD_CHARS:
                    source = batch.column("_html")[high].as_py()
                    rows.append(parsed_page(source))
                    chars += len(source)
                    high += 1
                part = batch.slice(low, high - low)
                yield pa.record_batch(
                    [part.column("page_id"), part.column("url"), part.column("host"),
                     pa.array([r[0] for r in rows], pa.list_(subtree)), pa.array([r[1] for r in rows], pa.list_(block))],
                    names=["page_id", "url", "host", "subtrees", "blocks"])
                low = high

    return pages.select("page_id", F.col("url").cast("string").alias("url"), host_of().alias("host"),
                        text_of("html").alias("_html")).mapInArrow(
        parse, f"page_id {id_type}, url string, host string, subtrees array<struct<key:bigint,parent:bigint,"
               "prose:boolean>>, blocks array<struct<text:string,marked:boolean,outside:boolean,keys:array<bigint>>>")


def site_templates(parts: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
                   prose_share: float = PROSE_SHARE) -> DataFrame:
    """Per host the keys of subtrees that recur; at most a page's subtrees by ``1 / min_share``."""
    one = parts.select("host", F.explode("subtrees").alias("s")).select("host", "s.*")
    # first by parent, then by key: both combine on the map side, so a hot host or key is a row per task
    below = one.groupBy("host", "key", "parent").agg(F.count("*").alias("n"), F.max("prose").alias("prose"))
    again = below.groupBy("host", "key").agg(
        F.sum("n").alias("n"), F.count("*").alias("parents"), F.max("prose").alias("prose")).where(
        (F.col("n") >= min_pages) & (F.col("parents") >= min_pages))
    share = F.when(F.col("prose"), prose_share).otherwise(min_share)
    return again.join(parts.groupBy("host").agg(F.count("*").alias("pages")), "host").where(
        F.col("n") >= share * F.col("pages")).groupBy("host").agg(F.collect_list("key").alias("template"))


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE,
              prose_share: float = PROSE_SHARE) -> DataFrame:
    """The article of every page as text.

    Takes ``page_id``, ``url`` and ``html``; other columns are ignored, whatever their
    names. Returns one row per input row: page_id, url, text, n_chars long (code
    points), and the numbers of blocks left out because their subtree recurs on the host
    (n_template) or only because of a name, a class or their place outside the article
    (n_marked). White space within a
    block becomes one space, blocks are joined by one space in page order, and character
    references are decoded as browsers do. A null or empty page has an empty text; pages
    without a host form one site; null ids and repeated rows stay; an empty table gives
    an empty result; markup may be cut off or badly nested anywhere. A page of any
    length is parsed whole, in one pass. Copies of a page keep their text, since what
    recurs below one parent only is no template.
    """
    parts = stored(parsed(pages), "parsed_pages")
    templates = stored(site_templates(parts, min_pages, min_share, prose_share), "templates")
    # a small table of templates is broadcast by its size; a large one meets the pages by host, where
    # adaptive execution splits a hot host and repeats its one row
    rows = parts.join(templates, "host", "left").withColumn(
        "_hit", F.array_intersect(F.transform("subtrees", lambda s: s["key"]), 
        F.coalesce("template", F.array().cast("array<bigint>"))))
    cut = lambda b: F.arrays_overlap(b["keys"], F.col("_hit"))
    kept = F.filter("blocks", lambda b: ~b["marked"] & ~b["outside"] & ~cut(b))
    rows = rows.withColumn("text", F.array_join(F.transform(kept, lambda b: b["text"]), " "))
    return rows.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
        F.size(F.filter("blocks", cut)).cast("long").alias("n_template"),
        F.size(F.filter("blocks", lambda b: (b["marked"] | b["outside"]) & ~cut(b))).cast("long").alias("n_marked"))
