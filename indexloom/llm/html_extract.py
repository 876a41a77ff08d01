"""Main text of web pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Lines whose weights are summed.
WINDOW_LINES = 3
#: Weight of a window from which text surges, about a line of prose; and below which it dives.
SURGE, DIVE = 80.0, 1.0
#: Weight that a heading, or a line inside the article, has beside its characters.
MARKED = 30.0
#: Weight of a character inside boilerplate elements, and outside the article on pages whose article is trusted.
BOILERPLATE_SHARE, OUTSIDE_SHARE = 0.01, 0.05
#: Share of the page's prose that article elements must hold to be trusted.
TRUSTED = 0.5

# Element names of HTML, roles, and words of classes and ids that name boilerplate.
UNSEEN = {"head", "script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "button", "select", "textarea"}
RAW = {"script", "style", "textarea", "noscript", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "dialog", "menu"}
ARTICLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold the whole page, whatever their class says.
WHOLE = {"html", "body", "main"}
BOUNDARY_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
#: Elements that another start tag of the list closes when it was left open.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOILERPLATE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsored", "promo", "cookie", "cookies", "consent", "notice", "newsletter", "popup", "sidebar", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "masthead", "comments", "commentlist", "comment", "share", "social"}
LAYOUT_PREFIXES = ("no-", "with-", "without-", "has-", "is-")

_OPEN = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TO_QUOTE = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


class Line(NamedTuple):
    """A block of text, its characters in links, and what encloses it."""

    text: str
    linked: int = 0
    article: bool = False
    boilerplate: bool = False
    heading: bool = False


def _says(attributes: str) -> str:
    """"unseen", "boilerplate" or nothing, by hidden, role, class and id."""
    if "=" not in attributes and "hidden" not in attributes.lower():
        return ""
    said = ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" and not value or name == "aria-hidden" and value == "true":
            return "unseen"
        if name == "role" and value in BOUNDARY_ROLES:
            said = "boilerplate"
        if name in ("class", "id") and any(not BOILERPLATE_WORDS.isdisjoint(_WORD.findall(x)) for x in value.split() if not x.startswith(LAYOUT_PREFIXES)):
            said = "boilerplate"
    return said


class _Tags:
    """Finds tags from left to right; each character is looked at a bounded number of times, whatever is left open."""

    def __init__(self, page: str):
        self.page = page
        self.unclosed: set[str] = set()  # quotes that don't come again

    def end(self, at: int) -> int:
        """Where the tag whose name ends at ``at`` ends: its ``>`` outside quotes, or else the page's end.

        A quote that never closes counts as a plain character.
        """
        page, n = self.page, len(self.page)
        while True:
            at = _TO_QUOTE.match(page, at).end()
            if at >= n or page[at] == ">":
                return at
            close = -1 if page[at] in self.unclosed else page.find(page[at], at + 1)
            if close < 0:
                self.unclosed.add(page[at])
                at += 1
            else:
                at = close + 1


def lines(page: str) -> list[Line]:
    """The blocks of the page, markup and unseen elements stripped, in one pass over it.

    A block ends at any tag that isn't inline; a rule and the end of boilerplate leave an empty line. Left open tags end
    with their parent; end tags that match nothing are skipped.
    """
    out: list[Line] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = [("", False, False, False, False, False)]  # name, unseen, article, boilerplate, heading, link
    blocks, count = [0], Counter()  # places in the stack of elements that aren't inline; open elements by name
    linked = dull = size = 0  # characters of the block in links, in boilerplate and in all

    def close() -> None:
        nonlocal linked, dull, size
        if text:
            line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if line:
                _, _, article, _, heading, _ = stack[blocks[-1]]
                out.append(Line(line, min(linked, len(line)), article, 2 * dull >= size, heading))
            text.clear()
        linked = dull = size = 0

    def unwind(to: int) -> None:
        was = stack[-1][3]
        while len(stack) > to:
            count[stack.pop()[0]] -= 1
            if blocks[-1] == len(stack):
                blocks.pop()
        if was and not stack[-1][3]:
            out.append(Line(""))

    def add(part: str) -> None:
        nonlocal linked, dull, size
        if part and not stack[-1][1]:
            text.append(part)
            size += len(part)
            dull += len(part) if stack[-1][3] else 0
            linked += len(part) if stack[-1][5] else 0

    tags, at, n = _Tags(page), 0, len(page)
    while at < n:
        begin = _OPEN.search(page, at)
        if not begin:
            add(page[at:])
            break
        start = begin.start()
        add(page[at:start])
        if page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            at = n if stop < 0 else stop + 3
            continue
        if page.startswith("<![CDATA[", start):
            stop = page.find("]]>", start)
            add(html.escape(page[start + 9 : stop if stop >= 0 else n]))
            at = n if stop < 0 else stop + 3
            continue
        if page[start + 1 : start + 2] in ("!", "?"):
            stop = page.find(">", start)
            at = n if stop < 0 else stop + 1
            continue
        ends = page.startswith("/", start + 1)
        m = _NAME.match(page, start + 1 + ends)
        if not m:
            add("<")
            at = start + 1
            continue
        stop = tags.end(m.end())
        name, attributes, at = m[0].lower(), page[m.end() : stop], stop + 1
        if name == "br":
            add(" ")
            continue
        if name not in INLINE:
            close()
        if ends:
            if count[name] > 0:
                to = len(stack) - 1
                while stack[to][0] != name:
                    to -= 1
                unwind(to)
            continue
        if name in VOID:
            if name == "hr":
                out.append(Line(""))
            continue
        if name in CLOSES and stack[blocks[-1]][0] in CLOSES[name]:
            unwind(blocks[-1])
        _, unseen, article, boilerplate, heading, link = stack[-1]
        says = _says(attributes) if name not in WHOLE else ""
        unseen = unseen or name in UNSEEN or says == "unseen"
        boilerplate = boilerplate or name in BOILERPLATE or says == "boilerplate"
        if name not in INLINE:
            blocks.append(len(stack))
        stack.append((name, unseen, article or name in ARTICLE, boilerplate, heading or name in HEADINGS, link or name == "a"))
        count[name] += 1
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            stop = end.start() if end else n
            add(page[at:stop])
            at = stop
    close()
    return out


def weights(rows: list[Line]) -> list[float]:
    """What each line adds to the distribution: its characters outside links, by the elements around it.

    Lines that are mostly links have none. Characters in boilerplate count little. Where article elements hold most of
    the page's prose, characters outside them count little too and links inside them like others; a heading, and a line
    inside such an article, has some weight beside its characters. Elsewhere article elements say nothing, so a page
    whose teasers are articles keeps its body.
    """
    free = [len(r.text) - r.linked if 2 * r.linked < len(r.text) else 0 for r in rows]
    prose = sum(f for r, f in zip(rows, free, strict=True) if not r.boilerplate)
    inside = sum(f for r, f in zip(rows, free, strict=True) if r.article and not r.boilerplate)
    trusted = inside and inside >= TRUSTED * prose
    out = []
    for r, f in zip(rows, free, strict=True):
        if r.boilerplate:
            out.append(BOILERPLATE_SHARE * f)
        elif trusted:
            out.append(MARKED + len(r.text) if r.article and r.text else OUTSIDE_SHARE * f)
        else:
            out.append(f + MARKED if r.heading and f else float(f))
    return out


def main_text(page: str, window: int = WINDOW_LINES, surge: float = SURGE, dive: float = DIVE) -> str:
    """The text between the surges and dives of the line-block distribution.

    At line i the distribution is the weight of lines i to i + window - 1. Text surges at a line where it reaches
    ``surge`` (or half the page's greatest window, if none does) and that has its part of it, ``surge`` / ``window``, itself;
    it dives where the distribution falls below ``dive``. Between them lines with that part stay, and so do lighter ones
    that weigh at least half a unit for each character, which leaves out what stands in boilerplate or off the article.
    """
    rows = lines(page)
    weight = weights(rows)
    n = len(rows)
    block = [sum(weight[i : i + window]) for i in range(n)]
    most = max((block[i] for i in range(n) if rows[i].text and not rows[i].boilerplate), default=0.0)
    if not most:
        return ""
    surge = surge if most >= surge else most / 2
    kept, i, part = [], 0, surge / window
    while i < n:
        if block[i] < surge or weight[i] < part:
            i += 1
            continue
        while i < n and block[i] >= min(dive, surge):
            if rows[i].text and (weight[i] >= part or 2 * weight[i] >= len(rows[i].text)):
                kept.append(rows[i].text)
            i += 1
    return "\n".join(kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages`` (page_id, url, html).

    The whole html is read; null, empty or text-free html gives the empty text. Repeated rows and nulls in other columns
    pass through, further columns are dropped, an empty table gives no rows. No shuffle; a slice of pages is in memory.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x or "") for x in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return common.map_text(pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), "html"), run, "page_id long, url string, text string, n_chars long", text_col="html")
