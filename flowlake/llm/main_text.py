"""The main text of web pages by line-block distribution.

A page is stripped of its markup into lines: every block element, line break,
table cell and list item starts a new line, other elements leave their text
where it is.  A line has a weight, its characters outside links; a line's block
is the sum over the ``WINDOW`` lines from it on.  Where the blocks surge (a line
of some weight whose block reaches ``SURGE``) the main text begins, where they
dive (a block under ``SURGE / WINDOW``) it ends, and all lines between a surge
and the next dive are kept, short ones too.  A page may surge more than once.
Where no block reaches ``SURGE``, the page's highest block is the surge.

Markup is used while it is stripped.  Text of scripts, styles and the like is
no text.  Regions that their element, role, class or id marks as menu, header,
footer, sidebar, notice, advert, form or reader comments (``DROPPED``,
``DROPPED_MARKS``) are stripped with the markup and leave one empty line.  A
main article inside such a region, as after an unclosed menu, is not part of
it.  Where a page marks its article (an ``article`` or ``main`` element, else
a class or id of ``CONTENT_MARKS``), its lines weigh ``SURGE`` at least and
lines elsewhere nothing, so the blocks surge and dive at its edges; a marked
article whose text does not reach ``SURGE`` is passed over if another does.
Elsewhere a line of prose (``PROSE``) weighs enough to keep the blocks from
diving, a line that is mostly link weighs nothing, and other lines count from
half a surge on.

A header inside an article keeps its headings, a form around a page keeps its
marked article.  A page of short lines only is weighed by their length.  Character references are
decoded once, white space in a line becomes one blank, lines are joined by one
blank.  A page is read once from left to right, so the work grows with its
length; unclosed, stray and truncated tags are read as browsers do, but for
misnested inline elements, which carry no structure.  Defined results: a null
or empty page and a page without text give no lines and the empty text; rows
are independent, so repeated rows, ties and null ids keep one result each; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lines in a block, and the characters of a block at which the text surges.
WINDOW, SURGE = 3, 80

#: Fixed values of HTML: elements without content, elements whose content is no markup, blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe xmp noembed noframes".split())
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre
    search section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PROSE = set("p blockquote pre dd figcaption".split())

#: Regions that are no main text: elements, roles, and words of a class or id.
DROPPED = set("""nav footer aside form noscript template head svg math select button menu dialog search object canvas
    audio video fieldset""".split())
DROPPED_ROLES = set("""navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar
    toolbar""".split())
DROPPED_MARKS = set("""ad ads adv advert adverts advertisement advertisements advertising adsense adbox banner sponsor
    sponsored sponsors promo promos promotion promoted sidebar sidebars sidenav aside nav navbar
    navigation menu menus breadcrumb breadcrumbs header masthead topbar footer cookie cookies cookiebar consent gdpr
    notice notices notification notifications alert alerts popup modal overlay paywall newsletter subscribe subscription
    signup login signin share sharing social comment comments commentlist disqus respond reply replies related
    recommended recommendations pagination pager toolbar copyright disclaimer form search""".split())
#: A class or id with one of these words says something about the layout, not about the region.
LAYOUT_MARKS = set("has with no without".split())
CONTENT_MARKS = set("article articlebody post postbody entry story content maincontent main".split())

_TAG = re.compile(
    r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _marks(attributes: str) -> tuple[list[set[str]], str]:
    """The words of each class and id of a tag, and its role."""
    names, role = [], ""
    if "=" in attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "")
            if name in ("class", "id"):
                for one in value.split():
                    words = _WORD.findall(one)
                    names.append({w.lower() for w in words} | {"".join(words).lower()})
            elif name == "role":
                role = value.strip().lower()
            elif name == "itemprop" and value.strip().lower() == "articlebody":
                names.append({"articlebody"})
    return names, role


class _Open:
    """An open element and what holds inside it."""

    __slots__ = ("tag", "dropped", "article", "content", "heading", "block")

    def __init__(self, tag, dropped, article, content, heading, block):
        self.tag = tag
        # 0 kept, 1 dropped, 2 dropped with any article in it, 3 dropped but for headings, 4 but for marked content
        self.dropped = dropped
        self.article, self.content = article, content  # number of the marked region, 0 outside
        self.heading = heading
        self.block = block  # place of the innermost block in the stack


class Line:
    __slots__ = ("text", "linked", "tag", "article", "content")

    def __init__(self, text, linked, tag, article, content):
        self.text, self.linked, self.tag, self.article, self.content = text, linked, tag, article, content


class _Page:
    """The lines of a page, read once."""

    def __init__(self, html: str):
        self.lines: list[Line | None] = []  # None: text was dropped here
        self.stack = [_Open("", 0, 0, 0, False, 0)]
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.link_parts: list[str] = []
        self.link = 0  # depth of the stack at which a link began
        self.regions = 0
        self._read(html)
        self._end_line()

    def _read(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                return
            if lt > at:
                self._text(html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 2 if html.startswith("<!-->", lt) else lt + 4)
                at = n if end < 0 else end + 3
            elif html.startswith(("<!", "<?"), lt):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            elif m := _TAG.match(html, lt):
                at = m.end()
                tag = m[2].lower()
                if m[1]:
                    self._close(tag)
                elif tag in RAW:
                    end = re.compile(f"</{tag}(?=[\\s/>])[^>]*", re.I).search(html, at)
                    at = n if end is None else min(n, end.end() + 1)
                else:
                    self._start(tag, m[3])
            elif re.match(r"</?[a-zA-Z]", html[lt:lt + 3]):
                return  # a tag that the page's end cut off
            else:
                self._text("<")
                at = lt + 1

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        if top.dropped and not (top.dropped == 3 and top.heading):
            if not self.parts and self.lines and self.lines[-1] is not None and not raw.isspace():
                self.lines.append(None)
            return
        self.parts.append(raw)
        if self.link:
            self.link_parts.append(raw)

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            if text:
                top = self.stack[self.stack[-1].block]
                linked = len("".join(unescape("".join(self.link_parts)).split()))
                self.lines.append(Line(text, linked, top.tag, top.article, top.content))
            self.parts, self.link_parts = [], []

    def _pop(self) -> None:
        gone = self.stack.pop()
        self.open[gone.tag] -= 1
        if self.link >= len(self.stack) + 1:
            self.link = 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "hr":
            self._end_line()
            return
        if tag in VOID:
            return
        if tag == "a":
            self.link = len(self.stack) if "href" in attributes.lower() else 0
        names, role = _marks(attributes)
        block = tag in BLOCKS
        if block:
            self._end_line()
            if self.open.get("p"):
                while self.stack[-1].tag != "p":
                    self._pop()
                self._pop()
            inner = self.stack[self.stack[-1].block]
            if inner.tag in ("li", "td", "th", "tr", "dd", "dt", "option") and (
                    inner.tag == tag or {inner.tag, tag} in ({"td", "th"}, {"dd", "dt"}) or tag == "tr" and inner.tag != "li"):
                self._close(inner.tag)
                if tag == "tr" and self.stack[self.stack[-1].block].tag == "tr":
                    self._close("tr")
        top = self.stack[-1]
        marked = [w for w in names if w & DROPPED_MARKS and not w & LAYOUT_MARKS]
        comments = any(w & {"comment", "comments", "commentlist", "respond", "disqus"} for w in marked)
        dropped, article, content = top.dropped, top.article, top.content
        if tag in ("article", "main") or role == "main":
            if not dropped and (comments or marked and article) or dropped == 2:
                dropped = 2
            else:
                dropped = 0
                if tag == "article" or not article:
                    self.regions += 1
                    article = article or self.regions
        elif tag in ("html", "body"):
            pass
        elif dropped in (0, 4):
            content_mark = any(w & CONTENT_MARKS for w in names) and not marked
            if dropped == 4 and content_mark:
                dropped = 0
            if dropped:
                pass
            elif comments:
                dropped = 2
            elif tag == "header" or marked and all(w & DROPPED_MARKS <= {"header"} for w in marked) or role == "banner":
                dropped = 3 if article or content else 1
            elif tag in DROPPED or role in DROPPED_ROLES or marked:
                dropped = 2 if tag == "aside" else 4 if tag == "form" else 1
            if not dropped and not content and content_mark:
                self.regions += 1
                content = self.regions
        heading = tag in HEADINGS or top.heading and not block
        if block or dropped != top.dropped:
            place = len(self.stack) if block else top.block
            self.stack.append(_Open(tag, dropped, article, content, heading, place))
            self.open[tag] = self.open.get(tag, 0) + 1

    def _close(self, tag: str) -> None:
        if tag == "br" or tag in BLOCKS:
            self._end_line()
        if tag == "a":
            self.link = 0
        if self.open.get(tag):
            while self.stack[-1].tag != tag:
                self._pop()
            self._pop()


def lines(html: str | None) -> list[Line | None]:
    """The lines of a page without its markup; None where marked regions were dropped."""
    return _Page(html).lines if html else []


def weights(found: list[Line | None]) -> list[int]:
    """The weight of every line in the distribution."""
    for region in ("article", "content"):
        size: dict[int, int] = {}
        for x in found:
            if x is not None and (number := getattr(x, region)):
                size[number] = size.get(number, 0) + len(x.text) - x.linked
        chosen = {k for k, v in size.items() if v >= min(SURGE, max(size.values()))}
        if chosen:
            return [max(SURGE, len(x.text)) if x is not None and getattr(x, region) in chosen else 0 for x in found]
    out = []
    for x in found:
        if x is None or 2 * x.linked > len(x.text):
            out.append(0)
            continue
        plain = len(x.text) - x.linked
        if x.tag in PROSE:
            out.append(max(plain, -(-SURGE // WINDOW)))
        elif x.tag in HEADINGS:
            out.append(max(plain, SURGE // WINDOW - 1))
        else:
            out.append(plain if 2 * plain >= SURGE else 0)
    if not any(out):  # nothing but short lines
        out = [0 if x is None or 2 * x.linked > len(x.text) else len(x.text) - x.linked for x in found]
    return out


def spans(weight: list[int]) -> list[tuple[int, int]]:
    """From each surge to the next dive, as half-open ranges of lines."""
    n = len(weight)
    blocks = [sum(weight[i:i + WINDOW]) for i in range(n)]
    surge = min(SURGE, max(blocks, default=0))
    out, start = [], None
    for i, b in enumerate(blocks):
        if start is None and weight[i] and b >= surge:
            start = i
        elif start is not None and WINDOW * b < surge:
            out.append((start, i))
            start = None
    return out + ([(start, n)] if start is not None else [])


def main_lines(html: str | None) -> list[str]:
    """The lines of a page's main text."""
    found = lines(html)
    weight = weights(found)
    marked = any(x is not None and (x.article or x.content) for x in found)
    return [x.text for a, b in spans(weight) for x, w in zip(found[a:b], weight[a:b])
            if x is not None and (w or not marked)]


def extract(html: Column) -> Column:
    """array<string> of the lines of each page's main text."""
    def batches(pages: pa.Array) -> pa.Array:
        return pa.array([main_lines(x.as_py()) for x in pages], pa.list_(pa.string()))

    return F.arrow_udf(batches, "array<string>")(html)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """id, url, the main text of every page and its number of code points."""
    text = pages.select(id_col, url, F.array_join(extract(F.col(html).cast("string")), " ").alias("text"))
    return text.select("*", F.length("text").cast("long").alias("n_chars"))
