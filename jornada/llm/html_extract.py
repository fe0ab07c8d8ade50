"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by the block they stand in,
tags by their name; the weights are log-odds counted on labelled pages (those that
mark their content with ``article`` or ``main``), with words positive and tags
negative where nothing was seen. One linear scan finds the contiguous region of the
highest total; its blocks are the text. A region may leave or enter ``article`` or
``main`` at a fixed cost, so the marks are one bounded feature beside the weights. Elements that are never content (menus,
headers, footers, sidebars, forms, scripts, styles, and elements whose class, id or
role says advert, notice or comments) score below zero and are left out of the
region's text.

Defined cases: a null or empty page, or one without words, gives an empty text;
cut-off markup ends where the page ends; repeated rows are extracted each on their
own; without a labelled page the start weights are used; empty tables give no rows.
Extra columns are ignored. Pages are read whole.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator

import math
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their role in a page.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "xmp")
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
NEVER = ("head", "nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu",
         "object", "canvas", "audio", "video", "label", "fieldset")
INLINE = ("a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var")
BLOCK = ("p", "div", "section", "article", "main", "body", "html", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol",
         "li", "dl", "dt", "dd", "table", "thead", "tbody", "tr", "td", "th", "blockquote", "pre", "figure",
         "figcaption", "address", "hr", "br", "img", "details", "summary")
CONTENT = ("article", "main")
#: What a region pays each time its text passes into or out of a content element.
CROSSING = 10.0
#: Class, id and role words of what isn't content; words that a role's box adds to its
#: name; and words before a role that say what the element beside it has.
ROLES = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "banner", "cookie", "cookies",
    "consent", "notice", "notices", "sidebar", "comment", "comments", "replies", "disqus", "related", "share", "social",
    "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header", "popup", "modal",
    "newsletter", "subscribe", "signup", "contentinfo", "complementary"))
BOXES = frozenset((
    "area", "bar", "block", "body", "box", "buttons", "container", "content", "form", "inner", "item", "items", "left",
    "links", "list", "panel", "posts", "right", "section", "slot", "text", "thread", "top", "unit", "widget", "wrap",
    "wrapper"))
STATES = frozenset(("has", "is", "no", "with", "without"))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"']+)))?")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[-_]+")


def is_role(token: str) -> bool:
    """Whether one class, id or role token names something that isn't content: it ends
    in such a word (``site-footer``) or is one with the name of its box (``comment-list``).
    ``comments-open`` and ``has-sidebar`` are states of another element."""
    parts = [p for p in _PARTS.split(token.lower()) if p]
    if not parts or parts[0] in STATES:
        return False
    return parts[-1] in ROLES or parts[0] in ROLES and all(p in BOXES or p in ROLES for p in parts[1:])


def is_dropped(attributes: str) -> bool:
    """Whether an element's attributes hide it or name a role that isn't content. Only
    the attributes meant for that count, never the values of others."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if (name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                or name == "style" and _HIDDEN_STYLE.search(value)
                or name in ("class", "id", "role") and any(map(is_role, value.split()))):
            return True
    return False


def _kind(name: str) -> str:
    return name if name in BLOCK or name in INLINE or name in NEVER else "other"


def tokens(page: str) -> list[tuple[str, str | None, bool, bool]]:
    """(kind, text or None for a tag, dropped, inside a content element) in page order.

    A text run's kind is ``w:`` and the block it stands in; a tag's is its name.
    """
    out = []
    stack: list[tuple[str, bool, bool]] = []  # name, dropped, content
    at = 0
    n = len(page)

    def state():
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def text(a, b):
        if b > a:
            run = page[a:b]
            block = next((s[0] for s in reversed(stack) if s[0] not in INLINE), "body")
            out.append((f"w:{_kind(block)}", htmllib.unescape(run), *state()))

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            rest = page.rfind("<", at)
            cut = rest if rest >= 0 and re.match(r"</?[A-Za-z!?]?[^>]*\Z", page[rest:]) and (
                rest + 1 == n or page[rest + 1] in "/!?" or page[rest + 1].isalpha()) else n
            text(at, cut)
            break
        text(at, m.start())
        at = m.end()
        if m[1] is None:
            continue
        name, closing = m[1].lower(), page[m.start() + 1] == "/"
        if closing:
            # Close the nearest open element of that name, with what it holds open.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            out.append((_kind(name), None, *state()))
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name == "p" or name in ("li", "tr", "td", "dt", "dd"):  # these end an open one of their kind
            if stack and stack[-1][0] == name:
                stack.pop()
        dropped, content = state()
        if not dropped:
            dropped = name in NEVER or (name not in ("html", "body", *CONTENT) and is_dropped(m[2] or ""))
        content = content or name in CONTENT
        if name not in VOID and not (m[2] or "").endswith("/"):
            stack.append((name, dropped, content))
        out.append((_kind(name), None, dropped, content))
    return out


def _weight_key(kind: str, dropped: bool) -> str:
    return f"{kind}/x" if dropped else kind


def count_kinds(page: str) -> Counter:
    """(kind, inside) -> tokens, for a page that marks its content; empty otherwise."""
    found: Counter = Counter()
    rows = tokens(page)
    if any(inside for *_, inside in rows):
        for kind, text, dropped, inside in rows:
            found[_weight_key(kind, dropped), inside and not dropped] += len(text.split()) if text is not None else 1
    return found


def train(pages: DataFrame) -> dict[str, float]:
    """Weights per kind from all labelled pages: log-odds of standing in the content.

    Kinds are a fixed list, so the counts that reach the driver are a few hundred rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(count_kinds(page.as_py() or ""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in total], pa.string()), pa.array([i for _, i in total], pa.bool_()),
             pa.array(list(total.values()), pa.int64())], ["kind", "inside", "n"])

    rows = (pages.select("html").mapInArrow(run, "kind string, inside boolean, n bigint")
            .groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect())
    return weights_of({(r["kind"], r["inside"]): r["n"] for r in rows})


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Weights per kind from its tokens inside and outside the content."""
    out = {}
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 1) / (counts.get((kind, False), 0) + 1))
        # Words stay positive and tags negative, except in dropped elements.
        out[kind] = max(min(odds, 3.0), 0.1) if kind.startswith("w:") and not kind.endswith("/x") else \
            -max(0.05, min(3.0, 1.0 - odds / 2 if not kind.endswith("/x") else 1.0))
    return out


def weight(weights: dict[str, float], kind: str, dropped: bool) -> float:
    key = _weight_key(kind, dropped)
    start = -1.0 if dropped else 1.0 if kind.startswith("w:") else -0.5
    return weights.get(key, start)


def best_region(rows: list[tuple[str, str | None, bool, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """(begin, end) of the contiguous tokens of the highest total, of equal ones the one
    that ends first; (0, 0) where none is above zero. Each change into or out of a content
    element between two texts of the region costs CROSSING."""
    best, best_span, total, begin = 0.0, (0, 0), 0.0, 0
    # Dropped elements are skipped by the scan: an advert inside an article doesn't end it.
    within = None  # whether the last text stood inside a content element
    for i, (kind, text, dropped, inside) in enumerate(rows):
        words = len(text.split()) if text is not None else 1
        score = 0.0 if dropped and inside else weight(weights, kind, dropped) * words
        if text is not None and words and not dropped:
            total -= CROSSING * (within is not None and within != inside)
            within = inside
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, best_span = total, (begin, i + 1)
    return best_span


def extract(page: str, weights: dict[str, float]) -> str:
    """The text of the highest-scoring region of a page."""
    rows = tokens(page)
    begin, end = best_region(rows, weights)
    parts = []
    for kind, text, dropped, _ in rows[begin:end]:
        if dropped:
            parts.append(" ")
        elif text is not None:
            parts.append(text)
        elif kind not in INLINE:
            parts.append(" ")
    return " ".join("".join(parts).split())


def extract_pages(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p.as_py() or "", weights) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
