"""Main text of web pages (operator 9).

Blocks: markup is read in one pass. Scripts, styles, forms, menus, headers, footers, sidebars,
notices, adverts and reader comments are left out by element name or by the words of their class,
id and role; character references are decoded; block elements end a block, and white space inside
a block becomes one space. A page that has an `article` or `main` element consists of the blocks
inside it.

Nearest-URL page differencing follows for every page: within each host pages stand in order of
their URL path, each page is paired with the neighbour whose path is most alike, both lists of
blocks are aligned by their longest common subsequence, and the aligned blocks are template and
deleted. A neighbour with which more than COPY of either page is shared is a copy, a preview or a near
copy and says nothing about the template, so the next of the NEIGHBOURS on either side that differs
takes its place; a page without any keeps its text. Articles are differenced among themselves and with
more care, as copies and quotations between them are content: a neighbour that shares more than
ARTICLE_COPY is a copy, and a line is template only where all of the nearest 2 * NEIGHBOURS articles that
are no copies, RECURS at least, have it at aligned places.

Only hashes of the pages' blocks are sorted by URL, not the pages.

Defined results: null and empty html give an empty text; a null url stands first, as a host of its
own; rows with equal ids or urls stay, and equal rows get equal results; unclosed elements and
truncated pages end at the end of the page; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqlake.llm.rows import map_groups, map_rows, shuffle_partitions
from seqlake.operators.batches import with_row_index
from seqlake.session import materialize

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)"
    r"(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+(?=>|\Z)|[^>]*+)(?:>|\Z)",
    re.S)
RAW = frozenset("script style textarea title noscript template iframe svg math xmp".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset(
    "nav header footer aside form menu dialog button select head object canvas audio video "
    "datalist fieldset".split()) | RAW
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul"
    .split())
#: Words of class, id or role that mark what is not the article.
FURNITURE = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter "
    "notice notices pagination popup promo promoted related share sharing sidebar social sponsor "
    "sponsored subscribe toolbar complementary contentinfo search".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
LABEL = re.compile(
    r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(
    r"""(?:^|\s)(?:hidden(?=[\s=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""",
    re.I)
ARTICLES = ("article", "main")
NEIGHBOURS, COPY = 2, 0.8
#: Inside articles: what counts as a copy, and how many neighbours must have a line for it to be template.
ARTICLE_COPY, RECURS = 0.5, 3
#: Places in a run, which one task holds at a time; more than 4 * NEIGHBOURS.
RUN = 1024


def _furniture(name: str, attrs: str) -> bool:
    if name in LEFT_OUT:
        return True
    if not attrs or name in ("html", "body", "main"):
        return False
    if HIDDEN.search(attrs):
        return True
    return any(word in FURNITURE for m in LABEL.finditer(attrs)
               for word in re.split(r"[\s_-]+", (m[1] or m[2] or m[3] or "").lower()))


def blocks(page: str | None) -> tuple[list[str], bool]:
    """Blocks of the page outside of its furniture, and whether they come from an own article."""
    if not page:
        return [], False
    inside: list[str] = []
    outside: list[str] = []
    stack: list[tuple[str, bool]] = []  # open elements; whether each is left out
    text: list[str] = []
    dropped = articles = at = 0
    seen_article = False

    def end_block() -> None:
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            (inside if articles else outside).append(block)

    def close(depth: int) -> None:
        nonlocal dropped, articles
        while len(stack) > depth:
            name, out = stack.pop()
            dropped -= out
            articles -= name in ARTICLES and not out

    while at < len(page):
        m = TAG.search(page, at)
        stop = m.start() if m else len(page)
        if not dropped and stop > at:
            text.append(html.unescape(page[at:stop]))
        if not m:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            end_block()
        elif name == "br":
            text.append(" ")
        if m["close"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                # an end tag inside left-out matter does not reach out of its block elements
                if stack[depth][0] in ("body", "html") and name not in ("body", "html"):
                    break
            continue
        attrs = m["attrs"]
        if name in VOID or attrs.rstrip().endswith("/") and name in ("svg", "math"):
            continue
        if name in CLOSES_P and stack:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] in BLOCKS:
                    break
        out = _furniture(name, attrs)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((name, out))
        dropped += out
        if name in ARTICLES and not out:
            if not dropped:
                seen_article = True
            articles += 1
    end_block()
    return (inside, True) if seen_article else (outside, False)


def block_hash(block: str) -> int:
    return xxhash.xxh64_intdigest(block) - (1 << 63)


def shared(mine: list[int], other: list[int]) -> list[int]:
    """Places in `mine` of a longest common subsequence with `other`. Equal ends are taken first;
    rows of the length table are built as arrays."""
    front = 0
    while front < min(len(mine), len(other)) and mine[front] == other[front]:
        front += 1
    back = 0
    while back < min(len(mine), len(other)) - front and mine[-1 - back] == other[-1 - back]:
        back += 1
    a = np.array(mine[front : len(mine) - back], np.int64)
    b = np.array(other[front : len(other) - back], np.int64)
    # what the other side does not have cannot be shared
    a_at, b = np.flatnonzero(np.isin(a, b)), b[np.isin(b, a)]
    a = a[a_at]
    lengths = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i in range(len(a) - 1, -1, -1):
        hit = np.where(b == a[i], lengths[i + 1, 1:] + 1, lengths[i + 1, :-1])
        lengths[i, :-1] = np.maximum.accumulate(hit[::-1])[::-1]
    places, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            places.append(front + int(a_at[i]))
            i, j = i + 1, j + 1
        elif lengths[i + 1, j] >= lengths[i, j + 1]:
            i += 1
        else:
            j += 1
    return [*range(front), *places, *range(len(mine) - back, len(mine))]


def template_places(page: dict, near: list[dict]) -> list[int]:
    """Places of the page's template among its blocks. The neighbours are taken by the likeness of their
    paths. The first that is no copy tells the template; of an article only what recurs at aligned
    places of all others that are no copies, which are at least RECURS in all."""
    mine, article = page["hashes"], page["article"]
    known = set(mine)

    def alike(other: dict) -> tuple:
        n = sum(1 for _ in _common(page["path"], other["path"]))
        return n, -abs(other["place"] - page["place"]), -other["place"]

    template, told = None, 0
    for other in sorted(near, key=alike, reverse=True):
        theirs = other["hashes"]
        places = [] if known.isdisjoint(theirs) else shared(mine, theirs)
        if len(places) > (ARTICLE_COPY if article else COPY) * min(len(mine), len(theirs)):
            continue
        template = places if template is None else sorted({*template}.intersection(places))
        told += 1
        if not article or not template:
            return template
    return template if template and told >= RECURS else []


def template_blocks(pages: DataFrame) -> DataFrame:
    """url, key (hash of the html) and the places of the blocks that a page shares with the nearest URL of
    the same host that is no copy of it. Pages with an own article and others stand apart."""
    def start():
        def step(url, key, page):
            out: tuple[list, ...] = ([], [], [], [])
            for u, k, p in zip(url, key, page):
                found, article = blocks(p)
                if found:
                    for column, value in zip(out, (u, k, article, [block_hash(b) for b in found])):
                        column.append(value)
            return out
        return step

    host = F.coalesce(F.lower(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract("url", "^(?:[a-zA-Z]+://[^/?#]*)?(.*)$", 1), F.lit(""))
    rows = pages.select("url", F.xxhash64("html").alias("key"), "html")
    undecided = map_rows(rows, "url string, key bigint, article boolean, hashes array<bigint>", start) \
        .distinct().select(host.alias("host"), path.alias("path"), "url", "key", "article", "hashes")
    # a sort by range, not a window by host: one host may have a third of all pages
    placed = with_row_index(undecided, ["host", "article", "path", "key"]) \
        .withColumnRenamed("row_index", "place")
    # runs of places, each with the neighbours of its ends: nearly all rows go to one run only
    ends = [F.floor((F.col("place") + n) / RUN) for n in (-2 * NEIGHBOURS, 2 * NEIGHBOURS)]
    dealt = placed.withColumn("run", F.explode(F.array_distinct(F.array(*ends))))

    def work(held: list[dict]) -> Iterator[tuple]:
        held.sort(key=lambda row: row["place"])
        for at, row in enumerate(held):
            if row["place"] // RUN != row["run"]:
                continue
            near = [o for o in held[max(0, at - 2 * NEIGHBOURS) : at + 2 * NEIGHBOURS + 1]
                    if o is not row and (o["host"], o["article"]) == (row["host"], row["article"])]
            if row["article"]:  # as many at the ends of a host
                near = sorted(near, key=lambda o: abs(o["place"] - row["place"]))[: 2 * NEIGHBOURS]
            else:
                near = [o for o in near if abs(o["place"] - row["place"]) <= NEIGHBOURS]
            places = template_places(row, near)
            if places:
                yield row["url"], row["key"], places

    return map_groups(dealt, "run", "url string, key bigint, template array<int>", work,
                      shuffle_partitions(pages.sparkSession))


def _common(a: str, b: str):
    for x, y in zip(a, b):
        if x != y:
            return
        yield x


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages` (columns page_id, url, html)."""
    rows = pages.select("page_id", "url", "html")
    # written first, so that Spark knows its size when it picks the join: pages are shuffled only where
    # the template is no small table
    template = materialize(template_blocks(rows), "page-template") \
        .select(F.col("url").alias("t_url"), F.col("key").alias("t_key"), "template")
    joined = rows.withColumn("key", F.xxhash64("html")).join(
        template, (F.col("key") == F.col("t_key")) & F.col("url").eqNullSafe(F.col("t_url")), "left"
    ).select("page_id", "url", "html", "template")

    def start():
        def step(page_id, url, page, shared_places):
            text = []
            for p, drop in zip(page, shared_places):
                found, _ = blocks(p)
                gone = set(drop or ())
                text.append("\n".join(b for i, b in enumerate(found) if i not in gone))
            return page_id, url, text, [len(t) for t in text]
        return step

    return map_rows(joined, "page_id bigint, url string, text string, n_chars bigint", start)
