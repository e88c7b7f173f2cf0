"""Main text of a page by line-block distribution.

The page is cut into lines, one per block element. Markup goes, and so does what
lies in elements that never hold the article: menus, footers, forms, scripts and
whatever names itself an advert, a notice, a sidebar or a comment; but on a page without
text in ``article`` or ``main``, an element that holds most of the page's unlinked text is
not judged by its name, unless that says that it holds comments. An ``article`` is judged by
whole names only (``comment-body``, not ``comments-open``). What goes leaves no empty line.

The lengths of the remaining lines, links not counted, are summed over windows of ``WINDOW``
lines. Text surges where a window's sum passes the threshold; lines from a surge to the next
dive are the main text. It dives where the sums drop sharply, to the threshold or to a third
of their peak, at a short line that is no sentence or is a copyright notice, and where more
than ``WINDOW`` lines in a row are links. So a short last paragraph stays and short lines
of a page's foot go. Lines in ``article`` or ``main`` count twice and with their links, do not dive,
and a surge there takes in the short lines that open the article. If such lines are at least
half of the text found, the rest is left out; else all stays.

One page is one row and no row needs another, so the work is a plain map.

Defined results
* A null, empty or text-free page gives an empty text of length 0.
* A page whose windows never pass ``SURGE`` is measured against half of its largest
  window instead: a very short article is kept.
* Cut-off pages end their open elements; an unclosed element ends with its parent.
* Repeated pages give repeated rows; extra columns are passed on, those named as a
  result column are replaced.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from stratalake.llm.common import column, others

WINDOW = 3
SURGE = 86
RESULT = ["text", "n_chars"]

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <[!?][^>]*(?:>|\Z)
    | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)
    | <(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NAMED = re.compile(r"[a-z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
BLOCK = frozenset(
    """address article aside blockquote body center caption dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
    p pre section summary table tbody td tfoot th thead tr ul""".split()
)
NEVER = frozenset(
    """aside audio button canvas datalist dialog footer form head iframe input map math menu nav noscript
    object option script select style svg template textarea title video""".split()
)
#: Words in class, id and role of elements that are not part of an article.
ASIDE = frozenset(
    """ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot sponsor
    sponsored sponsors promo promos promotion banner banners sidebar sidebars sidenav aside comment
    comments commentlist commentarea disqus reply replies respond notice notices notification alert
    alerts cookie cookies consent gdpr popup popups modal overlay newsletter subscribe subscription share
    sharing social related recommended recommendations breadcrumb breadcrumbs menu menus nav navbar
    navigation footer foot copyright toolbar pagination pager login signup signin search searchbox
    widget widgets skip dialog contentinfo complementary""".split()
)
#: Names of elements that hold readers' comments, by whole class, id or role.
COMMENT = re.compile(
    r"""(?:(?:user|reader|post|article)[-_]?)?
    (?:comments?|comment-?list|repl(?:y|ies)|disqus(?:_thread)?|respond|discussion)
    (?:[-_](?:body|content|text|item|list|thread|wrapper|wrap|box|area|section|block|container|author|meta|\d+))*""",
    re.X,
)
#: Ends of sentences; lines that are none may end an article.
SENTENCE = re.compile(r"""[.!?…:;。！？]["'”’»)\]]*$""")
NOTICE = re.compile(r"©|\(c\)\s*\d|\bcopyright\b|all rights reserved", re.I)
#: Words of elements that are the head of a page; within an article these may hold its title.
HEAD = frozenset("header masthead topbar head".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
ENDS_AT = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
           "th": {"table"}, "option": {"select"}}


def set_aside(tag: str, attrs: str, in_main: bool) -> bool:
    """Whether the element holds no article text, by its tag or as it is hidden."""
    if tag in NEVER or tag == "header" and not in_main:
        return True
    if tag in ("html", "body", "main"):
        return False
    for name, value in ATTR.findall(attrs):
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and "true" in value.lower():
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def named_aside(tag: str, attrs: str, in_main: bool) -> str | None:
    """``comment`` or ``other`` if the element calls itself something that is no part of an article."""
    if not attrs.strip() or tag in ("html", "body", "main"):
        return None
    kind = None
    for name, value in ATTR.findall(attrs):
        if name.lower() in ("class", "id", "role"):
            value = value.lower()
            whole = value.strip("\"'").split()
            if any(COMMENT.fullmatch(x) for x in whole):
                return "comment"
            words = set(whole if tag == "article" else NAMED.findall(value))
            if words & ASIDE or tag != "article" and not in_main and words & HEAD:
                kind = "other"
    return kind


class Lines:
    """The lines of a page: text, length outside links, and the number of the marked article, or 0."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.region = self.regions = 0

    def add(self, text: str, linked: bool) -> None:
        text = html.unescape(text) if "&" in text else text
        self.parts.append(text)
        if linked:
            self.linked += len(" ".join(text.split()))

    def end(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, max(0, len(text) - self.linked), self.region))
        self.parts, self.linked = [], 0


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """The lines; elements set aside by name count after all if they hold most of the page's text."""
    lines, most = cut_lines(page, frozenset())
    if most and not any(region for _, _, region in lines):
        lines, _ = cut_lines(page, most)
    return lines


def cut_lines(page: str, spared: frozenset[int]) -> tuple[list[tuple[str, int, int]], frozenset[int]]:
    """The lines, and where elements begin that are set aside by name but hold most unlinked text.

    ``spared``: places of elements that are not set aside for their names.
    """
    out, pos = Lines(), 0
    # Open elements, which of them are set aside, for those so by name the place and the text
    # before, and whether they hold comments.
    stack: list[tuple[str, bool, tuple[int, int] | None, bool]] = []
    opened: Counter[str] = Counter()
    aside = never = volume = 0
    held: list[tuple[int, int]] = []

    def pop_to(depth: int) -> None:
        nonlocal aside, never
        while len(stack) > depth:
            tag, was, named, comment = stack.pop()
            opened[tag] -= 1
            aside -= was
            never -= was and not named
            if named and not comment:
                held.append((named[0], volume - named[1]))
            if was and not aside:
                out.end()
        marked()

    def marked() -> None:
        if opened["article"] + opened["main"] == 0:
            out.region = 0
        elif not out.region:
            out.regions += 1
            out.region = out.regions

    def close(tags: set[str], limits: set[str]) -> None:
        """Ends the innermost of some elements, unless one of the limits is nearer."""
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in tags:
                return pop_to(depth)
            if stack[depth][0] in limits:
                return None
        return None

    while pos < len(page):
        found = TOKEN.search(page, pos)
        text = page[pos : found.start() if found else len(page)]
        if text and not aside:
            out.add(text, opened["a"] > 0)
        if text and not never and not opened["a"]:
            volume += len(" ".join(text.split()))
        if not found:
            break
        pos = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if tag == "br" and not aside:
            out.add(" ", False)
        if tag in BLOCK and not aside:
            out.end()
        if found["end"] or found["end2"]:
            if opened[tag] > 0:
                close({tag}, set())
            continue
        if tag in VOID:
            continue
        attrs = found["attrs"] or found["attrs2"] or ""
        if tag in BLOCK and opened["p"] > 0:
            close({"p"}, {"article", "main", "section", "div", "td", "th", "li", "blockquote", "button", "aside"})
        if tag in CLOSED_BY:
            close(CLOSED_BY[tag], ENDS_AT[tag])
        if tag in ("article", "main") and aside and not opened["article"] + opened["main"]:
            # An unclosed advert or menu does not swallow the article; comments may be articles.
            if not any(x[0] in ("form", "dialog") or x[3] for x in stack if x[1]):
                pop_to(next(i for i, x in enumerate(stack) if x[1]))
        if tag == "body" and aside:
            pop_to(next(i for i, x in enumerate(stack) if x[1]))
        if tag in RAW:
            close_tag = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(page, pos)
            pos = close_tag.start() if close_tag else len(page)
        self_never = set_aside(tag, attrs, out.region > 0)
        named = None
        if not self_never and found.start() not in spared:
            named = named_aside(tag, attrs, out.region > 0)
        self_aside = self_never or named is not None
        if self_aside and not aside:
            out.end()
        stack.append((tag, self_aside, (found.start(), volume) if named else None, named == "comment"))
        opened[tag] += 1
        aside += self_aside
        never += self_never
        marked()
    pop_to(0)
    out.end()
    return out.lines, frozenset(place for place, n in held if 2 * n > volume)


def main_lines(lines: list[tuple[str, int, int]]) -> list[str]:
    """Lines between each surge and the next dive of the summed lengths."""
    # The mark of an article is a bonus: its links count too, and its lines twice.
    weights = [2 * len(text) if region else n if 2 * n >= len(text) else 0 for text, n, region in lines]
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    surge = min(SURGE, max(sums, default=0) // 2)
    kept, before, inside, peak, linked = [], [], False, 0, 0
    for (text, n, region), weight, total in zip(lines, weights, sums, strict=True):
        if not weight:
            linked += 1
            inside = inside and linked <= WINDOW
            continue
        linked = 0
        if total > surge:
            peak = max(peak, total) if inside else total
            inside = True
        if inside and not region and weight <= surge and total <= max(surge, min(peak // 3, 2 * surge)):
            inside = bool(SENTENCE.search(text)) and not NOTICE.search(text)
        if inside:
            # A surge in a marked article reaches back to the article's short first lines.
            kept += [line for line in before if line[2] == region]
            kept.append((text, n, region))
            before = []
        elif region:
            before.append((text, n, region))
    # If marked articles hold at least half of what was found, they are the page's text.
    marked = sum(n for _, n, region in kept if region)
    if marked and 2 * marked >= sum(n for _, n, _ in kept):
        return [text for text, _, region in kept if region]
    return [text for text, _, _ in kept]


def main_text(page: str | None) -> str:
    return "\n\n".join(main_lines(lines_of(page))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """The columns of ``pages`` without ``html``, with ``text`` and ``n_chars``."""

    @pandas_udf("string")
    def main_texts(batch: pd.Series) -> pd.Series:
        return batch.map(lambda page: main_text(page) if isinstance(page, str) else "")

    kept = [column(c) for c in others(pages, [*RESULT, "html"])]
    return pages.select(*kept, main_texts(column("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
