"""Word-processor documents: the ordered top-level paragraphs and tables of their body."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCKS = (
    "path string, pos int, style string, text string, spans array<struct<start:int,stop:int,weight:string>>, "
    "grid array<array<struct<text:string,colspan:int,heading:boolean,continues:boolean>>>, problem string"
)


def _on(node) -> bool:
    return node is not None and node.get(f"{W}val", "true") not in ("0", "false", "off")


def paragraph(node) -> tuple[str | None, str, list[dict]]:
    """Style, text with tabs and breaks as white space, and the spans of bold and italic runs."""
    style = node.find(f"{W}pPr/{W}pStyle")
    text, spans = "", []
    for run in node.iter(f"{W}r"):
        start = len(text)
        for part in run:
            text += part.text or "" if part.tag == f"{W}t" else "\t" if part.tag == f"{W}tab" else "\n" if part.tag == f"{W}br" else ""
        weight = "+".join(n for n, t in (("bold", "b"), ("italic", "i")) if _on(run.find(f"{W}rPr/{W}{t}")))
        if weight and len(text) > start:
            spans.append({"start": start, "stop": len(text), "weight": weight})
    return style.get(f"{W}val") if style is not None else None, text, spans


def table(node) -> list[list[dict]]:
    rows = []
    for row in node.findall(f"{W}tr"):
        heading, cells = _on(row.find(f"{W}trPr/{W}tblHeader")), []
        for cell in row.findall(f"{W}tc"):
            span, merge = cell.find(f"{W}tcPr/{W}gridSpan"), cell.find(f"{W}tcPr/{W}vMerge")
            words = " ".join(" ".join(paragraph(p)[1].split()) for p in cell.iter(f"{W}p")).strip()
            cells.append({"text": words, "colspan": int(span.get(f"{W}val", "1")) if span is not None else 1, "heading": heading, "continues": merge is not None and merge.get(f"{W}val", "continue") == "continue"})
        rows.append(cells)
    return rows


def body_blocks(data: bytes) -> list[tuple]:
    """(style, text, spans, grid) of a document; raises ValueError if it is none."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{W}body")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError) as error:
        raise ValueError(f"not a document: {error}") from error
    if body is None:
        raise ValueError("not a document: no body")
    out = []
    for node in body:
        if node.tag == f"{W}p":
            out.append((*paragraph(node), None))
        elif node.tag == f"{W}tbl":
            out.append((None, "", [], table(node)))
    return out


def document_blocks(documents: DataFrame) -> DataFrame:
    """Blocks of documents (path, content); an unreadable one is a row with its ``problem``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "pos", "style", "text", "spans", "grid", "problem"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows = [(path, i, *block, None) for i, block in enumerate(body_blocks(bytes(content)))]
                except ValueError as error:
                    rows = [(path, None, None, None, None, None, str(error))]
                yield pd.DataFrame(rows, columns=names).astype({"pos": "Int32"})

    return documents.select("path", "content").mapInPandas(run, BLOCKS)
