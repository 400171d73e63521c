"""Main text of web pages: structure first, then a suffix array over what a host repeats.

Markup tells menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments from
the article, and a marked article is kept whole, even where other pages repeat it. Text in none of
these, beside a marked article too, is judged by its host: the word streams of the host's pages are
concatenated, a suffix array finds runs of words that distinct pages share, the covered words are
boilerplate, and unique runs stay. Every host has its suffix array, and streams hold what stands outside
of marked articles, so boilerplate is learned from all pages.

A small host is one suffix array. The suffixes of a larger one are dealt out by a hash of their first
words, so that equal ones meet wherever their pages are and no task takes a large host whole. Both find
the same words. Pages of equal text count as one page.

Edge cases: a null or empty page, and one without text, has an empty text. A null address is a host of
its own. Unclosed elements end with the one around them, and an article inside an unclosed menu ends
that. An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import html as markup
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of, written
from tripcohorts.llm.words import Rolling, split_words, text_bytes, window_hashes

#: Words that pages of different text must share in a row, and words of a host that one suffix array holds.
LEAST_SHARED, PART_WORDS = 8, 400_000

#: Elements and marks of what is not the article.
RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "noembed", "noframes", "xmp")
OUTSIDE = {
    "nav", "header", "footer", "aside", "form", "menu", "dialog", "template", "svg", "math", "object", "head", "button",
    "select", "canvas", "audio", "video",
}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "html", "legend", "li", "main", "ol", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "header", "masthead", "footer",
    "sidebar", "aside", "related", "recommended", "share", "sharing", "social", "comment", "comments", "disqus", "respond",
    "reply", "replies", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter",
    "subscribe", "subscription", "signup", "login", "search", "widget", "toolbar", "skip",
}

#: Marks of an article that is a reader's, and elements that marks say nothing about within an article.
READERS = {"comment", "comments", "reply", "replies"}
TEXT = {"h1", "h2", "h3", "h4", "h5", "h6", "p"}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_UNQUOTED_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_DECLARATION = re.compile(r"<[!?][^>]*+>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_MARK_PARTS = re.compile(r"[^a-z0-9]+")
_HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


def _is_outside(name: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is none of the article by its name or marks."""
    if name in OUTSIDE and not (in_article and name == "header"):
        return True
    if not attributes.strip() or name in ("html", "body", "main"):
        return False
    found = {m[1].lower(): next((g for g in m.groups()[1:] if g is not None), "") for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if found.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", found.get("style", ""), re.IGNORECASE):
        return True
    if in_article and name in TEXT:
        return False
    marks = f"{found.get('class', '')} {found.get('id', '')}".lower()
    return not (READERS if name == "article" else MARKS).isdisjoint(_MARK_PARTS.split(marks))


class _Tags:
    """Tags, comments and declarations of a page in order; none of its text is gone over again and again.

    Quotes around attributes may hold angles. Where a quote is never closed, the tag and all after it
    end at their first angle.
    """

    def __init__(self, page: str):
        self.page, self.last, self.pattern = page, page.rfind(">"), _TAG

    def after(self, at: int) -> tuple[int, int, re.Match | None] | None:
        """Begin, end and (of an element) match of the next one from a place on."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, len(page) if end < 0 else end + 3, None
            if start > self.last:
                at = self._before_comment(start)
                continue
            found = self.pattern.match(page, start)
            if not found and self.pattern is _TAG and _UNQUOTED_TAG.match(page, start):
                self.pattern = _UNQUOTED_TAG
                found = self.pattern.match(page, start)
            if found:
                return start, found.end(), found
            if other := _DECLARATION.match(page, start):
                return start, other.end(), None
            at = start + 1
        return None

    def _before_comment(self, start: int) -> int:
        """Where the next comment begins, or the end: nothing else can come after the last closing angle."""
        found = self.page.find("<!--", start)
        return found if found >= 0 else len(self.page)


def blocks_of(page: str) -> tuple[list[str], list[str], list[str], list[int]]:
    """Blocks in marked articles, blocks outside of everything marked, other blocks, and how many blocks of articles precede each of the second."""
    article: list[str] = []
    loose: list[str] = []
    other: list[str] = []
    before: list[int] = []
    text: list[str] = []
    outside, depth = "", 0  # the element that hides what is in it, and elements of its name that are open
    articles = at = 0

    def close_block() -> None:
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            if not outside and not articles:
                before.append(len(article))
            (other if outside else article if articles else loose).append(block)

    def add(raw: str) -> None:
        if raw:
            text.append(markup.unescape(raw) if "&" in raw else raw)

    tags = _Tags(page)
    while found := tags.after(at):
        start, end, match = found
        add(page[at:start])
        at = end
        if not match:
            continue
        name, closing = match[2].lower(), bool(match[1])
        if name == "br":
            text.append(" ")
        if name in _RAW_END and not closing:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
            continue
        main = name in ("article", "main")
        hides = not closing and not outside and name not in VOID and _is_outside(name, match[3], articles > 0)
        if name in BLOCKS or main or hides or name == outside or name in OUTSIDE:
            close_block()
        if closing:
            if outside and name == outside:
                depth -= 1
                outside = outside if depth else ""
            elif main and articles and not outside:
                articles -= 1
        elif outside and main and outside not in ("article", "main") and outside in ("nav", "header", "aside", "form", "head", "menu"):
            outside, depth, articles = "", 0, articles + 1
        elif outside:
            depth += name == outside and not match[3].endswith("/")
        elif hides:
            if not match[3].endswith("/"):
                outside, depth = name, 1
        elif main:
            articles += 1
    rest = page[at:]
    add(re.sub(r"<[a-zA-Z/!?][^>]*$", "", rest))
    close_block()
    return article, loose, other, before


def shared_words(words: list[list[str]], texts: np.ndarray | None = None) -> list[np.ndarray]:
    """For each stream of words, which ones are in runs that another stream (or another one of `texts`) has too.

    A suffix array of all streams after each other, sorted by the first LEAST_SHARED words by
    doubling: suffixes that agree in these have one rank, and neighbours of one rank from different
    streams mark their words. Longer runs are marked piece by piece.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    if total < LEAST_SHARED:
        return [np.zeros(size, bool) for size in sizes]
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for stream in words for w in stream), np.int64, total)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    places = np.arange(total)
    rank, length = ids, 1
    while length < LEAST_SHARED:
        step = min(length, LEAST_SHARED - length)
        # a suffix that ends first gets a rank of its own
        after = np.where(places + step < ends, rank[np.minimum(places + step, total - 1)], -1 - places)
        order = np.lexsort((after, rank))
        new = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
        rank = np.zeros(total, np.int64)
        rank[order] = np.append(0, np.cumsum(new))
        length += step
    order = np.argsort(rank, kind="stable")
    first = np.flatnonzero(np.append(True, rank[order][1:] != rank[order][:-1]))
    of = owner if texts is None else texts[owner]
    low, high = np.minimum.reduceat(of[order], first), np.maximum.reduceat(of[order], first)
    several = np.repeat(low != high, np.diff(np.append(first, total)))
    starts = order[several]
    starts = starts[starts + LEAST_SHARED <= ends[starts]]
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, starts, 1)
    np.subtract.at(change, starts + LEAST_SHARED, 1)
    covered = np.cumsum(change[:-1]) > 0
    return np.split(covered, np.cumsum(sizes)[:-1])


def _left(blocks: list[str], open_from: int, covered: np.ndarray) -> list[str]:
    """Each open block without the covered words."""
    at, kept = 0, []
    for place, block in enumerate(blocks):
        words = block.split(" ")
        left = [w for w, gone in zip(words, covered[at : at + len(words)], strict=True) if not gone]
        at += len(words)
        if place >= open_from:
            kept.append(" ".join(left))
    return kept


def _in_order(article: str, before: list[int], left: list[str]) -> str:
    """The blocks of the article and what is left of the open ones, in page order."""
    blocks = article.split("\n") if article else []
    merged, at = [], 0
    for place, block in zip(before, left, strict=True):
        merged += blocks[at:place]
        at = place
        if block:
            merged.append(block)
    return "\n".join(merged + blocks[at:])


def _unique_runs(table: pd.DataFrame) -> pd.DataFrame:
    """row, left of the pages with open blocks: these without shared words."""
    streams = [[word for block in blocks for word in block.split(" ")] for blocks in table["blocks"]]
    kinds: dict[str, int] = {}
    texts = np.array([kinds.setdefault(" ".join(stream), len(kinds)) for stream in streams], np.int64)
    rows, left = [], []
    for row, open_from, blocks, covered in zip(table["row"], table["open_from"], table["blocks"], shared_words(streams, texts), strict=True):
        if open_from < len(blocks):
            rows.append(row)
            left.append(_left(blocks, open_from, covered))
    return pd.DataFrame({"row": np.array(rows, np.int64), "left": pd.Series(left, dtype=object)})


def _first_words(streams: DataFrame) -> DataFrame:
    """row, host, kind, open, window, at (places) of the first words of each suffix, once in a page.

    `kind` is equal for pages of equal text.
    """

    def work(part: pa.RecordBatch) -> dict:
        joined = pa.array([" ".join(blocks) for blocks in part.column("blocks").to_pylist()], pa.string())
        data, bounds = text_bytes(joined)
        rolling = Rolling(data)
        words = split_words(data, bounds, _SPACE, rolling)
        at, window = window_hashes(words, LEAST_SHARED)
        page = words.text[at]
        order = np.lexsort((window, page))
        page, window, place = page[order], window[order], (at - words.first[page])[order]
        first = np.flatnonzero(np.append(True, (page[1:] != page[:-1]) | (window[1:] != window[:-1]))[: len(page)])
        offsets = pa.array(np.append(first, len(page)), pa.int32())
        page = page[first]
        return {
            "row": part.column("row").take(pa.array(page)),
            "host": part.column("host").take(pa.array(page)),
            "kind": rolling.of(bounds[:-1], bounds[1:]).view(np.int64)[page],
            "open": part.column("open").take(pa.array(page)),
            "window": window[first].view(np.int64),
            "at": pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))),
        }

    schema = "row long, host string, kind long, open boolean, window long, at array<int>"
    return map_texts(streams.select("row", "host", "blocks", F.expr(_HAS_OPEN).alias("open")), work, schema, column=None)


#: Whether a page has text that markup does not settle.
_HAS_OPEN = "open_from < size(blocks)"

_SPACE = np.zeros(256, bool)
_SPACE[0x20] = True


def _unique_runs_of_large(streams: DataFrame) -> DataFrame:
    """The same as `_unique_runs` for hosts of any size."""
    windows = written(_first_words(streams), "windows")
    shared = windows.groupBy("host", "window").agg(F.min("kind").alias("low"), F.max("kind").alias("high"))
    # written, so that a window in very many pages is split by the join
    shared = written(shared.filter("low != high").select("host", "window"), "shared")
    places = windows.filter("open").join(shared, ["host", "window"]).groupBy("row")
    places = places.agg(F.flatten(F.collect_list("at")).alias("places"))

    def work(part: pa.RecordBatch) -> dict:
        left = []
        for blocks, begin, places in zip(*(part.column(n).to_pylist() for n in ("blocks", "open_from", "places")), strict=True):
            change = np.zeros(sum(block.count(" ") + 1 for block in blocks) + 1, np.int64)
            starts = np.array(places or [], np.int64)
            np.add.at(change, starts, 1)
            np.subtract.at(change, starts + LEAST_SHARED, 1)
            left.append(_left(blocks, begin, np.cumsum(change[:-1]) > 0))
        return {"row": part.column("row"), "left": left}

    pages = streams.filter(_HAS_OPEN).select("row", "blocks", "open_from").join(places, "row", "left")
    return map_texts(pages, work, "row long, left array<string>", column=None)


def parse(pages: DataFrame) -> DataFrame:
    """row, page_id, url, host, text of marked articles, blocks outside of them, words in these.

    In `blocks` those of marked elements come first; `open_from` is where the others begin, and `before`
    says how many blocks of articles precede each of these.
    """

    def work(part: pa.RecordBatch) -> dict:
        hosts, texts, blocks, begins, places, counts = [], [], [], [], [], []
        for url, page in zip(part.column("url").to_pylist(), part.column("html").to_pylist(), strict=True):
            article, loose, other, before = blocks_of(page)
            found = _HOST.match(url or "")
            hosts.append(found[1].lower() if found else url)
            texts.append("\n".join(article))
            blocks.append(other + loose)
            begins.append(len(other))
            places.append(before)
            counts.append(sum(block.count(" ") + 1 for block in other + loose))
        names = ("row", "page_id", "url", "declared")
        return {name: part.column(name) for name in names} | {
            "host": hosts, "text": texts, "blocks": blocks, "open_from": begins, "before": places, "words": counts,
        }

    html = text_of("html")
    declared = F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z0-9_-]+)", 1), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", html.alias("html"), declared.alias("declared")
    )
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"row long, page_id {kind}, url string, declared string, host string, text string, blocks array<string>, open_from int, before array<int>, words long"
    return map_texts(rows, work, schema, "html")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, and the language that its root element declares."""
    parsed = written(parse(pages), "pages")
    streams = parsed.select("row", F.coalesce("host", F.lit("\0")).alias("host"), "blocks", "open_from", "words")
    parts = streams.groupBy("host").agg(F.greatest(F.ceil(F.sum("words") / PART_WORDS), F.lit(1)).alias("parts"))
    hosts = written(parts, "hosts")
    judged = streams.join(hosts, "host")
    groups = judged.filter("parts = 1").select("row", "host", "blocks", "open_from").groupBy("host")
    runs = groups.applyInPandas(_unique_runs, "row long, left array<string>")
    if not hosts.filter("parts > 1").isEmpty():
        runs = runs.unionByName(_unique_runs_of_large(judged.filter("parts > 1")))
    runs = written(runs, "runs")

    def work(part: pa.RecordBatch) -> dict:
        columns = (part.column(name).to_pylist() for name in ("text", "before", "left"))
        names = ("page_id", "url", "declared")
        return {name: part.column(name) for name in names} | {"text": [_in_order(*values) for values in zip(*columns, strict=True)]}

    columns = ["page_id", "url", "declared", "text"]
    settled = parsed.filter(f"NOT {_HAS_OPEN}").select(columns)
    opened = parsed.filter(_HAS_OPEN).select(*columns, "row", "before").join(runs, "row")
    kinds = ", ".join(f"{name} {settled.schema[name].dataType.simpleString()}" for name in columns)
    both = settled.unionByName(map_texts(opened, work, kinds))
    text = F.col("text")
    return both.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), "declared")
