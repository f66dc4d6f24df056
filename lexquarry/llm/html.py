"""Main text of web pages by differencing a page against its nearest neighbour.

Pages are ordered by host and URL path; of the pages next to it in that order, a page is paired
with the one of its host that shares the longest leading path. Both pages' text lines (blocks)
are aligned by longest common subsequence, and lines that both have are deleted as boilerplate.

Differencing alone can't give the article: menus and adverts may differ from page to page, and two
pages may carry the same article. So markup has a say: lines in elements that are boilerplate by
tag, role or class are dropped whatever the neighbour has, and where a page marks its article
(``article`` or ``main``), the lines inside stay, the others go.

Order and memory: range partitions split a host of any size; a task streams its pages in order and
holds three. The ranges are fixed first, from the keys alone, and their first and last keys (two a partition)
are collected; those pages are also sent to the adjoining range, as neighbours only.

Edge cases: a null html is an empty page with an empty text; a null url counts as empty, host and
path then empty; rows that repeat a page are neighbours as any others, and keep their articles;
unclosed elements end where their parent does; a page without article and without neighbour keeps
all lines that aren't boilerplate by markup; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_batch

TEXTS = "page_id long, url string, text string, n_chars long, n_shared int"
HELD = 1 << 28  # bits of an alignment's rows held at a time

#: Fixed values of the HTML vocabulary.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
DROPPED = {
    "nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "select", "button", "svg", "head", "title", "object",
    "canvas", "audio", "video", "menu", "dialog", "textarea", "xmp", "noembed", "noframes", "input", "fieldset", "datalist", "map",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "gdpr", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "related", "respond",
    "share", "sharing", "sidebar", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
_TOKEN = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _boilerplate(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    found = {k.lower(): entities.unescape((v or "").strip("\"'")) for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or _HIDDEN.search(found.get("style", "")) or found.get("role", "").lower() in ROLES:
        return True
    named = {w.lower() for w in _WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    return bool(named & NAMES)


def lines(page: str | None) -> list[tuple[str, bool, bool]]:
    """Text blocks in page order as (text, inside an article, boilerplate by markup)."""
    page = page or ""
    out: list[tuple[str, bool, bool]] = []
    held: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, in article, boilerplate
    inside = dropped = False
    at, size, lower = 0, len(page), None

    def end() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, inside, dropped))

    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            held.append(page[at:])
            break
        if token.start() > at:
            held.append(page[at : token.start()])
        at = token.end()
        if token[0] == "<!--":
            close = page.find("-->", at)
            at = size if close < 0 else close + 3
            continue
        closing, tag, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag not in INLINE or (depth is not None and stack[depth][2]):
                end()
            if depth is not None and tag == "p" and any(x[0] not in INLINE for x in stack[depth + 1 :]):
                depth = None
            if depth is not None:
                del stack[depth:]
                inside, dropped = stack[-1][1:] if stack else (False, False)
            continue
        if tag in VOID:
            if tag not in INLINE:
                end()
            continue
        article = tag in ("article", "main")
        skip = dropped or _boilerplate(tag, attributes, inside)
        if tag not in INLINE or skip != dropped:
            end()
        if tag not in INLINE and stack:  # an open paragraph ends where a block begins
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
            if depth is not None and all(x[0] in INLINE for x in stack[depth + 1 :]):
                del stack[depth:]
                inside, dropped = stack[-1][1:] if stack else (False, False)
                skip = dropped or _boilerplate(tag, attributes, inside)
        if tag in RAW:
            lower = page.lower() if lower is None and len(page.lower()) == size else (lower or page)
            close = lower.find(f"</{tag}", at)
            at = size if close < 0 else page.find(">", close) + 1 or size
            continue
        stack.append((tag, inside or article, skip))
        inside, dropped = inside or article, skip
    end()
    return out


def _row(x: list[str], places: dict[str, int], row: int, full: int) -> int:
    """The bit row after the lines of ``x``; a column's bit is clear where the length steps up."""
    for text in x:
        if match := places.get(text, 0) & full:
            row = ((row + (row & match)) | (row & ~match)) & full
    return row


def common(a: list[str], b: list[str]) -> set[int]:
    """Indexes of ``a`` in a longest common subsequence with ``b`` (bit rows, read back from the end).

    Rows are held for ``HELD`` bits at most; longer stretches of ``a`` are halved, and the lower half's rows are made again,
    up to the column that is still needed. The result doesn't depend on where they are halved.
    """
    places: dict[str, int] = {}
    for j, text in enumerate(b):
        places[text] = places.get(text, 0) | 1 << j
    kept: set[int] = set()
    j = len(b)
    todo = [(0, len(a), (1 << j) - 1)]  # stretches of a, each with the row before it, last one first
    while todo and j:
        low, high, row = todo.pop()
        full = (1 << j) - 1
        row &= full
        if high - low > 1 and (high - low) * j > HELD:
            middle = (low + high) // 2
            todo += [(low, middle, row), (middle, high, _row(a[low:middle], places, row, full))]
            continue
        rows = [row]
        for text in a[low:high]:
            rows.append(_row([text], places, rows[-1], full))
        i = high - low
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1  # no step in this column: the length is that of one line less of b
            elif not rows[i - 1] >> (j - 1) & 1:
                i -= 1
            else:
                i, j = i - 1, j - 1
                kept.add(low + i)
    return kept


def extract(own: list[tuple[str, bool, bool]], other: list[tuple[str, bool, bool]] | None) -> tuple[str, int]:
    """Main text of a page's lines, and how many the neighbour took away."""
    shared = common([x[0] for x in own], [x[0] for x in other]) if other else set()
    marked = any(inside and not dropped for _, inside, dropped in own)
    text, gone = [], 0
    for i, (line, inside, dropped) in enumerate(own):
        if i in shared and not inside:
            gone += 1
        elif not dropped and (inside or not marked):
            text.append(line)
    return "\n\n".join(text), gone


def _leading(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split("/"), b.split("/"), strict=False):
        if x != y:
            break
        n += 1
    return n


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pages() -> Iterator[tuple]:
        for batch in batches:
            for page, url, html, host, path, guest in zip(*(batch[x] for x in ("page_id", "url", "html", "host", "path", "guest")), strict=True):
                yield page.as_py(), url.as_py(), host.as_py(), path.as_py(), lines(html.as_py()), guest.as_py()

    def row(before, now, after) -> tuple:
        near = [x for x in (before, after) if x and x[2] == now[2]]
        best = max(near, key=lambda x: _leading(x[3], now[3]), default=None)
        text, gone = extract(now[4], best and best[4])
        return now[0], now[1], text, len(text), gone

    def rows() -> Iterator[tuple]:
        before = now = None
        for after in pages():
            if now and not now[5]:
                yield row(before, now, after)
            before, now = now, after
        if now and not now[5]:
            yield row(before, now, None)

    held: list[tuple] = []
    for x in rows():
        held.append(x)
        if len(held) == 500:
            yield arrow_batch(TEXTS, *map(list, zip(*held, strict=True)))
            held = []
    if held:
        yield arrow_batch(TEXTS, *map(list, zip(*held, strict=True)))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared) of ``pages`` (page_id, url, html)."""
    spark = pages.sparkSession
    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    clean = F.coalesce("url", F.lit(""))
    keyed = own.withColumns({
        "host": F.lower(F.regexp_extract(clean, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)),
        "path": F.regexp_extract(clean, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1),
    })
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = "host", "path", "page_id", "digest"
    keyed = keyed.withColumn("digest", F.xxhash64("html"))
    ranges = keyed.select(*order).repartitionByRange(parts, *order).select(F.spark_partition_id().alias("part"), F.struct(*order).alias("key"))
    ends = sorted(ranges.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).collect())  # ``parts`` rows at most
    if ends:
        kind = ranges.schema["key"].dataType.simpleString()
        firsts, lasts = (F.from_json(F.lit(json.dumps([r[x].asDict() for r in ends])), f"array<{kind}>") for x in ("first", "last"))
        step = math.isqrt(len(ends)) + 1
        key = F.struct(*order)
        block = F.size(F.filter(F.from_json(F.lit(json.dumps([r["first"].asDict() for r in ends[::step]])), f"array<{kind}>"), lambda x: x <= key))
        keyed = keyed.withColumn("part", (block - 1) * step)
        keyed = keyed.withColumn("part", F.col("part") + F.size(F.filter(F.slice(firsts, F.col("part") + 1, F.lit(step)), lambda x: x <= key)) - 1)
        seat = lambda part, guest: F.struct(part.alias("part"), F.lit(guest).alias("guest"))
        before = F.when((F.col("part") > 0) & F.get(firsts, "part").eqNullSafe(key), seat(F.col("part") - 1, True))
        after = F.when((F.col("part") < len(ends) - 1) & F.get(lasts, "part").eqNullSafe(key), seat(F.col("part") + 1, True))
        keyed = keyed.select("url", "html", *order, F.inline(F.array_compact(F.array(seat(F.col("part"), False), before, after))))
    else:
        keyed = keyed.withColumns({"part": F.lit(0), "guest": F.lit(False)})
    near = keyed.repartitionById(parts, "part").sortWithinPartitions(*order).drop("part", "digest")
    return near.mapInArrow(_differ, TEXTS)


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


QUERIES = {"op4_page_text": op4_page_text}
