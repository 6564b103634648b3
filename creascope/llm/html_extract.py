"""Main text of web pages by line-block distribution.

A page is cut into blocks (headings, paragraphs, list items, cells). Markup, scripts and comments go,
and blocks inside navigation, headers, footers, side columns, adverts, notices, forms and reader
comments, or made up of links, are set aside. Every line weighs its text, a line set aside lacks its
share of ``SURGE``, the text of a window of ``WINDOW`` lines where main text begins. The weights are
summed over sliding windows; the main text surges where these sums grow and dives where they lack more
than the text behind gives: it is the run of windows with the largest total, so an advert inside it
does not end it. Where a page marks its article, that bounds the text: the lines outside are dropped,
and lines set aside inside it weigh nothing.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 3
SURGE = 80  # characters in a window

# Element and class names that have a fixed meaning in web pages.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
SILENT = ("script", "style", "noscript", "template", "svg", "head", "iframe", "object", "textarea", "title", "math", "canvas")
ASIDE = frozenset("nav footer aside form button select menu dialog label fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus footer form gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promotion recommended related replies "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets".split())
PAGE_HEADER = frozenset(("header",))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
QUIET = re.compile(r"<(%s)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)" % "|".join(SILENT), re.S | re.I)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
NAMES = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


def set_aside(name: str, attrs: str, inside: bool) -> bool:
    """Is an element no part of the main text, by its name or attributes?"""
    if name in ASIDE or (name in PAGE_HEADER and not inside):
        return True
    if not attrs or name in ("body", "html"):
        return False
    for key, *values in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "role" and value in ROLES or key == "aria-hidden" and value == "true":
            return True
        if key == "hidden" or key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id") and name not in ("article", "main") or key == "class":
            names = set(NAMES.findall(value))
            if names & MARKS or not inside and names & PAGE_HEADER:
                return True
    return False


def lines_of(page: str) -> list[tuple[str, bool, bool]]:
    """(text, set aside, inside the article) per block; texts are decoded, white space folded."""
    page = QUIET.sub(" ", page)
    lines, parts = [], []
    stack: list[tuple[str, bool, bool]] = []  # name, set aside, article
    linked = total = 0
    in_link = False

    def end_block() -> None:
        nonlocal linked, total
        text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            aside = any(entry[1] for entry in stack)
            article = any(entry[2] for entry in stack)
            lines.append((text, aside or (not article and linked * 2 > total), article))
        parts.clear()
        linked = total = 0

    def say(text: str) -> None:
        nonlocal linked, total
        if text:
            parts.append(text)
            size = len(text) - text.count(" ")
            total += size
            linked += size if in_link else 0

    at = 0
    for token in TOKEN.finditer(page):
        say(page[at:token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["close"]:
            if name == "a":
                in_link = False
            if name in BLOCKS:
                end_block()
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            continue
        if name == "a":
            in_link = True
        if name == "br":
            parts.append(" ")
        if name in BLOCKS:
            end_block()
        if name in VOID:
            continue
        inside = any(entry[2] for entry in stack)
        aside = set_aside(name, token["attrs"], inside)
        article = name in ("article", "main") and not aside
        if article and not inside and not any(entry[0] in ("div", "section", "aside") and entry[1] for entry in stack):
            stack.clear()  # menus that were never closed end here
            in_link = False
        if name in BLOCKS or aside or article:
            if name in ("p", "li", "option", "dt", "dd", "td", "th", "tr") and stack and stack[-1][0] == name:
                stack.pop()
            stack.append((name, aside, article))
    say(page[at:])
    end_block()
    return lines


def main_text(page: str | None) -> str:
    """The main text, blocks joined by one line break; empty for no page or none found."""
    if not page:
        return ""
    lines = lines_of(page)
    if any(article and not aside for _, aside, article in lines):
        lines = [line for line in lines if line[2] and not line[1]]
    # windows reach over both ends; entry i is the window that ends at line i
    weights = [-SURGE / WINDOW if aside else len(text) for text, aside, _ in lines] + [0] * (WINDOW - 1)
    best, total, start = (0, 0, 0), 0, 0
    for end in range(len(weights)):
        if total < 0:
            total, start = 0, end
        total += sum(weights[max(0, end - WINDOW + 1):end + 1])
        best = max(best, (total, -start, end))
    total, start, dive = best
    if not total:
        return ""
    return "\n".join(text for text, aside, _ in lines[max(0, -start - WINDOW + 1):dive + 1] if not aside)


def extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    NULL and empty pages and pages without main text have an empty text. NULL ids and urls and
    repeated rows are returned as they are. Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(extract_batches, "page_id long, url string, text string, n_chars long")
