"""HTML as DataFrames: blocks, links, emphasis, tables, images and addressed chunks.

Markup has to be walked, so these are Arrow-batched Python operators. The tree is the plain one of the
standard parser: an end tag closes the nearest open element of its name, one without is ignored,
void elements hold nothing, script and style are raw. Walks keep their own stack, so depth is no limit.
Offsets are code points in the normalised text, end exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Fixed values of the HTML vocabulary.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "dd", "div", "dl", "dt", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
    "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
EMPHASIS = ("b", "em", "i", "strong", "sup", "u")
SKIPPED = {"script", "style", "head", "nav", "footer"}
ZERO_WIDTH = {0x200B: None, 0x200C: None, 0x200D: None, 0xFEFF: None}


@dataclass(eq=False, slots=True)
class Node:
    tag: str
    attrs: dict = field(default_factory=dict)
    children: list = field(default_factory=list)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), 0)
        if at:
            del self.open[at:]

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parsed(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def walk(node: Node) -> Iterator[tuple[str, object]]:
    """("open", node), ("text", str), ("close", node) in document order."""
    stack: list[tuple[str, object]] = [("open", node)]
    while stack:
        kind, item = stack.pop()
        yield kind, item
        if kind == "open":
            stack.append(("close", item))
            stack += [("text", c) if isinstance(c, str) else ("open", c) for c in reversed(item.children)]


def visible(text: str) -> str:
    """Without characters of no width: ``translate``, but quick where there are none."""
    return text if text.isascii() or not any(chr(c) in text for c in ZERO_WIDTH) else text.translate(ZERO_WIDTH)


def find(node: Node, *tags: str) -> Node | None:
    """The first element of these names in document order."""
    stack = [node]
    while stack:
        item = stack.pop()
        if item.tag in tags:
            return item
        stack += [c for c in reversed(item.children) if isinstance(c, Node)]
    return None


def flattened(node: Node, tracked: frozenset[str] = frozenset()) -> tuple[str, list[tuple[Node, int, int]]]:
    """Normalised text, and where the tracked elements' text lies in it; an empty one sits at the next character."""
    parts: list[str] = []
    size, waiting, begun, empty, spans, skipping = 0, False, {}, [], [], 0

    def add(text: str) -> None:
        nonlocal size, waiting
        text = visible(text)
        if words := " ".join(text.split()):
            if size and (waiting or text[0].isspace()):
                parts.append(" ")
                size += 1
            for key in empty:
                begun[key] = size
            empty.clear()
            parts.append(words)
            size += len(words)
            waiting = text[-1].isspace()
        else:
            waiting = waiting or text != ""

    for kind, item in walk(node):
        if kind == "text":
            if not skipping:
                add(item)
            continue
        if item.tag in SKIPPED and item is not node:
            skipping += 1 if kind == "open" else -1
        if item.tag in BLOCK:
            waiting = True
        if item.tag in tracked and not skipping:
            if kind == "open":
                empty.append(id(item))
            else:
                start = begun.pop(id(item), None)
                if start is None and empty:  # the innermost one without text yet
                    empty.pop()
                nxt = size + (1 if waiting and size else 0)
                spans.append((item, nxt if start is None else start, nxt if start is None else size))
    text = "".join(parts)
    return text, [(n, min(a, len(text)), min(b, len(text))) for n, a, b in spans]


def table_grid(table: Node) -> dict:
    """Own rows and cells, spans other than 1 only, the header row only if declared, widest row's columns."""
    rows: list[tuple[Node, bool]] = []
    stack = [(c, table.tag) for c in reversed(table.children) if isinstance(c, Node)]
    while stack:
        node, parent = stack.pop()
        if node.tag == "tr":
            rows.append((node, parent == "thead"))
        elif node.tag in ("thead", "tbody", "tfoot"):
            stack += [(c, node.tag) for c in reversed(node.children) if isinstance(c, Node)]

    def span(cell: Node, name: str) -> int:
        found = cell.attrs.get(name, "")
        return int(found) if found.isdecimal() and int(found) > 1 else 1

    cells, header = [], None
    for i, (row, head) in enumerate(rows):
        own = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
        if header is None and own and (head or all(c.tag == "th" for c in own)):
            header = i
        cells.append([{"text": flattened(c)[0], "colspan": span(c, "colspan"), "rowspan": span(c, "rowspan")} for c in own])
    return {"rows": len(cells), "columns": max((sum(c["colspan"] for c in r) for r in cells), default=0), "header_row": header, "cells": cells}


#: What sets a heading in bold, what may wrap that, and the number such a heading begins with.
BOLD, INLINE = frozenset({"strong", "b"}), frozenset({"span", "em", "u", "i"})
NUMBERED = re.compile(r"([0-9]{1,3}(?:\.[0-9]{1,3})+)(\([a-z0-9]{1,3}\))?\.?(?=\s|:|$)")


def page_number(ref: str) -> str | None:
    """The dotted number of an address below its part; null if any segment is no number."""
    tail = ref.split("/")[2:]
    return ".".join(tail) if tail and all(re.fullmatch("[0-9]{1,3}", x) for x in tail) else None


def bold_heading(node: Node, number: str | None) -> int | None:
    """The level of a paragraph that is bold throughout and numbered below its page's own number; other bold text is prose."""
    inner = node
    while inner.tag not in BOLD:
        kept = [c for c in inner.children if isinstance(c, Node) or c.strip()]
        if len(kept) != 1 or not isinstance(kept[0], Node) or kept[0].tag not in BOLD | INLINE:
            return None
        inner = kept[0]
    found = NUMBERED.match(flattened(node)[0])
    if not number or not found or not found[1].startswith(f"{number}."):
        return None
    return found[1].count(".") + 2 + bool(found[2])


KINDS = {"p": "paragraph", "li": "list_item", "table": "table", "img": "image"} | {f"h{n}": "heading" for n in range(1, 7)}


def blocks(root: Node, number: str | None = None) -> list[dict]:
    """Paragraphs, list items (with depth), headings (with level and source), images and tables in order; other text as text blocks.

    With the page's ``number``, bold paragraphs numbered below it are headings too.
    """
    out: list[dict] = []
    loose: list[str] = []

    def flush() -> None:
        if text := " ".join(visible("".join(loose)).split()):
            out.append({"kind": "text", "depth": None, "text": text})
        loose.clear()

    stack: list[tuple[object, int]] = [(root, 0)]
    while stack:
        node, depth = stack.pop()
        if isinstance(node, str):
            loose.append(node)
            continue
        kind = KINDS.get(node.tag)
        bold = bold_heading(node, number) if number and (kind == "paragraph" or node.tag in BOLD) else None
        if node.tag in SKIPPED and node is not root:
            flush()
        elif bold:
            flush()
            out.append({"kind": "heading", "depth": None, "text": flattened(node)[0], "level": bold, "source": "emphasis"})
        elif kind == "image":
            flush()
            out.append({"kind": "image", "depth": None, "text": None})
        elif kind == "list_item":
            flush()
            nested = [c for c in node.children if isinstance(c, Node) and c.tag in ("ul", "ol")]
            own = Node("li", {}, [c for c in node.children if isinstance(c, str) or c.tag not in ("ul", "ol")])
            if text := flattened(own)[0]:
                out.append({"kind": kind, "depth": max(depth, 1), "text": text})
            stack += [(c, depth) for c in reversed(nested)]
        elif kind and not (kind == "paragraph" and any(find(c, "p", "table", "ul", "ol", "div") for c in node.children if isinstance(c, Node))):
            flush()
            if text := flattened(node)[0]:
                out.append({"kind": kind, "depth": None, "text": text} | ({"level": int(node.tag[1]), "source": "markup"} if kind == "heading" else {}))
        else:
            if node.tag in BLOCK:
                flush()
            stack += [(c, depth + (node.tag in ("ul", "ol"))) for c in reversed(node.children)]
    flush()
    return out


def canonical(root: Node) -> str:
    """The markup as open and close tags with meaningful attributes, text normalised: equal for equal content."""
    parts = []
    for kind, item in walk(root):
        if kind == "text":
            parts.append(" ".join(item.split()))
        elif item.tag:
            kept = "".join(f' {k}="{item.attrs[k]}"' for k in ("alt", "colspan", "href", "id", "rowspan", "src") if k in item.attrs) if kind == "open" else ""
            parts.append(f"<{'/' if kind == 'close' else ''}{item.tag}{kept}>")
    return "".join(x for x in parts if x)


NUMBER = re.compile(r"^\s*([0-9]+(?:\.[0-9]+)*)[.:]?(?:\s|$)")
LIMIT, LEAST = 2400, 120
#: Fixed value: a shorter heading without text is a marker, no passage.
MARKER = 5


def slug(text: str) -> str:
    return re.sub("[^a-z0-9]+", "-", text.lower()).strip("-")


def sections(found: list[dict]) -> list[tuple[list[str], list[str], str | None]]:
    """Blocks cut at headings, each section with its heading path, a stack by level, and what told its heading.

    A heading without text of its own is its section's text, unless a section below opens next, whose path has it, or it
    is shorter than ``MARKER``.
    """
    out: list[tuple[list[tuple[int, str]], list[str], str | None]] = [([], [], None)]
    stack: list[tuple[int, str]] = []
    for block in found:
        if block["kind"] == "heading":
            while stack and stack[-1][0] >= block["level"]:
                stack.pop()
            stack.append((block["level"], block["text"]))
            out.append((list(stack), [], block["source"]))
        elif block["text"]:
            out[-1][1].append(block["text"])
    # The next section's path is longer only if its heading lies below this one.
    opens = [len(after[0]) > len(here[0]) for here, after in zip(out, out[1:], strict=False)] + [False]
    kept = []
    for (path, texts, source), below in zip(out, opens, strict=True):
        if texts or path and not below and len(path[-1][1]) >= MARKER:
            kept.append(([x for _, x in path], texts or [path[-1][1]], source))
    return kept


def packed(texts: list[str]) -> list[list[str]]:
    """Greedy groups up to ``LIMIT`` characters; a group under ``LEAST`` joins the one before, or the next at the head."""
    groups: list[list[str]] = []
    size = 0
    for text in texts:
        if groups and size + len(text) <= LIMIT:
            groups[-1].append(text)
        else:
            groups.append([text])
            size = 0
        size += len(text) + 1
    out: list[list[str]] = []
    for group in groups:
        if out and (sum(map(len, group)) + len(group) - 1 < LEAST or sum(map(len, out[-1])) + len(out[-1]) - 1 < LEAST and len(out) == 1):
            out[-1] += group
        else:
            out.append(list(group))
    return out


def addressed(page: str, cut: list[tuple[list[str], list[str], str | None]]) -> list[dict]:
    """Chunks with addresses: the heading's number as a path, else its slug, else ``#n``; ``~i`` for fragments."""
    labels = [slug(path[-1]) if path else "" for path, _, _ in cut]
    counts = Counter(labels)
    out = []
    for i, (path, texts, source) in enumerate(cut):
        number = NUMBER.match(path[-1]) if path else None
        repeated = not labels[i] or counts[labels[i]] > 1
        tail = number[1].replace(".", "/") if number and not repeated else labels[i] if labels[i] and not repeated else f"#{i + 1}"
        groups = packed(texts)
        for k, group in enumerate(groups):
            ref = f"{page}/{tail}" + (f"~{k + 1}" if len(groups) > 1 else "")
            out.append({"chunk_ref": ref, "ordinal": len(out) + 1, "heading_path": path, "heading_source": source, "text": " ".join(group), "fragments": len(groups)})
    return out


def _body(html: str | None) -> Node:
    return _main(parsed(html))


def _main(root: Node) -> Node:
    return find(root, "main") or find(root, "article") or find(root, "body") or root


def _mapped(pages: DataFrame, rows, schema: str, *more: Column) -> DataFrame:
    """Rows of each page in Arrow batches; ids keep their type, beside nulls too, and few pages are held at a time."""
    schema = schema.replace("page_id long", f"page_id {pages.schema['page_id'].dataType.simpleString()}", 1)
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                given = batch.slice(start, 200).to_pydict().values()
                made = list(zip(*[r for page in zip(*given, strict=True) for r in rows(*page)]))
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(made, kind, strict=True)], schema=kind)

    return pages.select("page_id", "html", *[c.alias(f"more{i}") for i, c in enumerate(more)]).mapInArrow(run, schema)


def page_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, pos, kind, depth, text) of every block."""

    def rows(page, html):
        return [(page, i, b["kind"], b["depth"] or 0, b["text"]) for i, b in enumerate(blocks(_body(html)))]

    return _mapped(pages, rows, "page_id long, pos int, kind string, depth int, text string")


def page_spans(pages: DataFrame) -> DataFrame:
    """(page_id, kind, href, words, start, stop) of every link and emphasised stretch."""

    def rows(page, html):
        text, spans = flattened(parsed(html), frozenset({"a", *EMPHASIS}))
        return [(page, "link" if n.tag == "a" else n.tag, n.attrs.get("href", ""), text[a:b], a, b) for n, a, b in spans if n.tag == "a" or b > a]

    return _mapped(pages, rows, "page_id long, kind string, href string, words string, start int, stop int")


def broken_spans(pages: DataFrame) -> DataFrame:
    """Links and emphasis whose offsets don't name their own words: none, if offsets are right."""

    def rows(page, html):
        text, spans = flattened(parsed(html), frozenset({"a", *EMPHASIS}))
        return [(page, n.tag, a, b) for n, a, b in spans if text[a:b] != flattened(n)[0]]

    return _mapped(pages, rows, "page_id long, tag string, start int, stop int")


def _address(pages: DataFrame) -> Column:
    own = F.concat_ws("/", F.lit("P"), "page_id")
    return F.coalesce("page_ref", own) if "page_ref" in pages.columns else own


def page_chunks(pages: DataFrame) -> DataFrame:
    """(page_id, chunk_ref, ordinal, heading_path, heading_source, text, fragments, content_hash) of every page's chunks.

    Addresses begin with the page's ``page_ref``, where ``pages`` has that column, else with its id.
    """

    def rows(page, html, ref):
        cut = addressed(ref, sections(blocks(_body(html), page_number(ref))))
        return [(page, c["chunk_ref"], c["ordinal"], c["heading_path"], c["heading_source"], c["text"], c["fragments"]) for c in cut]

    schema = "page_id long, chunk_ref string, ordinal int, heading_path array<string>, heading_source string, text string, fragments int"
    return _mapped(pages, rows, schema, _address(pages)).withColumn("content_hash", F.concat(F.lit("sha256:"), F.sha2("text", 256)))


def page_parts(pages: DataFrame) -> DataFrame:
    """(page_id, chunk_ref, ordinal, text, href, words, start): the chunks and the links of every page, its markup parsed once.

    A row is a chunk of ``page_chunks`` (href is null) or a link of ``page_spans`` (chunk_ref is null).
    """

    def rows(page, html, ref):
        root = parsed(html)
        cut = addressed(ref, sections(blocks(_main(root), page_number(ref))))
        text, spans = flattened(root, frozenset({"a"}))
        return [(page, c["chunk_ref"], c["ordinal"], c["text"], None, None, None) for c in cut] + [(page, None, None, None, n.attrs.get("href", ""), text[a:b], a) for n, a, b in spans]

    return _mapped(pages, rows, "page_id long, chunk_ref string, ordinal int, text string, href string, words string, start int", _address(pages))


def page_tables(pages: DataFrame) -> DataFrame:
    """(page_id, ordinal, rows, columns, header_row, cells) of every table."""

    def rows(page, html):
        found = [table_grid(x) for kind, x in walk(_body(html)) if kind == "open" and x.tag == "table"]
        return [(page, i + 1, t["rows"], t["columns"], t["header_row"], t["cells"]) for i, t in enumerate(found)]

    return _mapped(pages, rows, "page_id long, ordinal int, rows int, columns int, header_row int, cells array<array<struct<text:string,colspan:int,rowspan:int>>>")


def page_images(pages: DataFrame) -> DataFrame:
    """(page_id, src, alt): distinct images of each page; a missing alt is null, an empty one empty."""

    def rows(page, html):
        return [(page, x.attrs.get("src", ""), x.attrs.get("alt")) for kind, x in walk(_body(html)) if kind == "open" and x.tag == "img"]

    return _mapped(pages, rows, "page_id long, src string, alt string").distinct()


def nav_entries(pages: DataFrame) -> DataFrame:
    """(page_id, pos, depth, title, href) of the entries of each page's nav lists, in order."""

    def rows(page, html):
        nav, depth, out = find(parsed(html), "nav"), 0, []
        for kind, x in walk(nav) if nav else ():
            if kind != "text" and x.tag in ("ul", "ol"):
                depth += 1 if kind == "open" else -1
            elif kind == "open" and x.tag == "a":
                out.append((page, len(out), depth, flattened(x)[0], x.attrs.get("href", "")))
        return out

    return _mapped(pages, rows, "page_id long, pos int, depth int, title string, href string")
