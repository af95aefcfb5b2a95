"""Main text of HTML pages by the line-block distribution.

A page is stripped of its markup into lines, one per block element.  Text in
page furniture (elements such as nav and footer, or of names that say so) and
lines that are mostly links count as lines without text.  The text lengths are summed over sliding windows of lines: a
stretch ends where the sum dives to nothing, in a window of furniture only,
and is kept if the sums to both sides of one of its lines surge over the
threshold, so the short lines beside a long one stay.  This is done on every
page; an article (or main) element only extends what was found: where a line
of it is kept, so are its other lines.  Where nothing surges, as on a page of
short lines, there is no larger text to prefer and all but furniture stays."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from marisnow.llm.common import with_kernel

WINDOW = 3
THRESHOLD = 86

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)>"
    r"|<[!?/][^>]*>", re.S | re.I)
#: elements without text of the page; noscript is one outside an article only
RAW = frozenset("title textarea noscript template iframe svg math canvas select button object".split())
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
LETTERS = re.compile(r"[a-z]+")
CLOSING = re.compile(r"</([a-z][a-z0-9:-]*)", re.I)

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: containers whose nesting is followed; paragraphs and the like end by themselves
NESTED = frozenset("div section article main nav header footer aside form ul ol dl table tbody thead tr td th figure "
                   "blockquote details fieldset body html head menu dialog".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
# Name parts that mark furniture whatever stands beside them; those that do so alone or beside other such and plain parts.
STRONG_NAMES = frozenset("nav navbar navigation menu footer sidebar aside ad ads advert advertisement adverts banner promo sponsor "
                         "sponsored cookie cookies consent popup modal comment comments reply replies disqus subscribe newsletter "
                         "breadcrumb breadcrumbs pagination pager widget login copyright toolbar contentinfo gdpr".split())
WEAK_NAMES = frozenset("header notice notices form share sharing social related search skip legal complementary disclaimer".split())
PLAIN_NAMES = frozenset("box bar bars link links list item items button buttons icon icons wrap wrapper container block area section "
                        "group row col column inner outer top bottom left right site page global main content".split())
#: share of a line's text in links from which on the line counts as links only
LINKED = 0.6


def _is_furniture(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in FURNITURE or tag == "header" and not in_article:
        return True
    if tag not in NESTED and tag not in ("p", "li", "span") or tag in ("body", "html", "main", "article") or not attrs:
        return False
    for m in NAMES.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = set(LETTERS.findall(name))
            if parts & STRONG_NAMES or parts & WEAK_NAMES and parts <= WEAK_NAMES | PLAIN_NAMES and not (in_article and "header" in parts):
                return True
    return False


def lines_of(page: str) -> list[tuple[str, bool, int, int]]:
    """(text, furniture, number of the outermost article or main element
    around it, 0 if none, characters outside links) of the page's blocks in
    page order."""
    lines: list[tuple[str, bool, int, int]] = []
    articles = 0
    last = {m[1].lower(): m.start() for m in CLOSING.finditer(page)}  # where each tag closes for the last time
    stack: list[tuple[str, bool, int]] = []  # tag, furniture from here on, article from here on
    opened: Counter = Counter()  # tags on the stack
    buffer: list[str] = []
    linked = [0]  # characters of the buffer in links
    links = 0

    def flush():
        if buffer:
            text = " ".join(entities.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                _, furniture, article = stack[-1] if stack else ("", False, 0)
                lines.append((text, furniture, article, 0 if linked[0] >= LINKED * len(text) else len(text)))
        linked[0] = 0

    def put(text):
        buffer.append(text)
        if links:
            linked[0] += len(text.strip())

    at = skip = 0
    for m in TOKEN.finditer(page):
        if m.start() < skip:  # inside an element without text
            continue
        at = max(at, skip)
        if m.start() > at:
            put(page[at:m.start()])
        at = m.end()
        name = m[3] or m[6]
        if not name:
            continue
        tag, closing, attrs = name.lower(), (m[2] or m[5]) == "/", m[4] or m[7] or ""
        _, furniture, article = stack[-1] if stack else ("", False, 0)
        if tag in RAW and not closing and not (tag == "noscript" and article) and last.get(tag, -1) >= at and not attrs.endswith("/"):
            end = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, at)
            skip = end.end() if end else len(page)
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
        if closing:
            if not opened[tag]:
                if tag not in INLINE:
                    flush()
                continue
            flush()
            while stack:  # up to the tag itself
                gone = stack.pop()[0]
                opened[gone] -= 1
                if gone == tag:
                    break
            continue
        marked = _is_furniture(tag, attrs, article > 0)
        if tag in INLINE and not marked:
            continue
        flush()
        if tag in VOID or attrs.endswith("/"):
            continue
        if (tag in NESTED or marked) and last.get(tag, -1) >= at:
            if not article and tag in ("article", "main") and not marked:
                articles += 1
                article = articles
            stack.append((tag, furniture or marked, article))
            opened[tag] += 1
    at = max(at, skip)
    if at < len(page):
        put(page[at:])
    flush()
    return lines


def kept_lines(lengths: list[int], window: int, threshold: int) -> list[bool]:
    """Which lines with text stand in a stretch with a surge; all of them if
    there is none."""
    return [length > 0 and k for length, k in zip(lengths, in_stretches(lengths, window, threshold))]


def in_stretches(lengths: list[int], window: int, threshold: int) -> list[bool]:
    """Which lines stand in a stretch with a surge, lines of length 0 inside
    it included; all lines with text if there is none.

    A stretch is a run of lines with text, less than ``window`` lines apart;
    it surges where the lengths of some window of lines around one of its
    lines sum up to ``threshold``."""
    n = len(lengths)
    sums = [0, *accumulate(lengths)]
    keep = [False] * n
    first = last = 0  # the stretch's first line and the one behind its last
    surge = False
    for i, length in enumerate(lengths):
        if not length:
            continue
        if not last or i - last >= window:  # dive: a whole window without text
            keep[first:last] = [surge] * (last - first)
            first, surge = i, False
        last = i + 1
        surge = surge or sums[min(i + window, n)] - sums[max(i - window + 1, 0)] >= threshold
    keep[first:last] = [surge] * (last - first)
    return keep if any(keep) else [length > 0 for length in lengths]


def main_text(page: str, window: int = WINDOW, threshold: int = THRESHOLD) -> str:
    """The page's main text, its blocks joined by one space.

    A line's length is its text outside furniture; a line that is mostly
    links counts 0, and goes unless it stands inside a kept stretch or in the
    same article as one."""
    lines = lines_of(page)
    keep = in_stretches([0 if furniture else own for _, furniture, _, own in lines], window, threshold)
    keep = [k and not furniture for k, (_, furniture, _, _) in zip(keep, lines)]
    found = {article for (_, _, article, _), k in zip(lines, keep) if k and article}
    return " ".join(text for (text, furniture, article, _), k in zip(lines, keep) if k or article in found and not furniture)


def extract(pages: DataFrame, html_col: str = "html", window: int = WINDOW, threshold: int = THRESHOLD) -> DataFrame:
    """``pages`` with its html replaced by ``text`` (empty if none) and
    ``n_chars``, its code points.

    Whole pages are read.  Null and empty pages, and pages of furniture only,
    have an empty text; each row is judged for itself, so repeated rows and
    an empty table need no rule.  Columns named text or n_chars are replaced,
    others pass through."""

    def kernel(texts):
        out = [main_text(t, window, threshold) for t in texts]
        return [pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())]

    return with_kernel(pages, html_col, kernel, "text string, n_chars long").drop(
        *([html_col] if html_col.lower() not in ("text", "n_chars") else []))
