"""Change reports in Markdown: made from capped, ordered rows, so their size is what people read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escaped_cell, natural_key
from ..sources.snapshot import Corpus
from . import changes as moves
from . import settling

CAP = 40


def counted(n: int, noun: str, plural: str | None = None) -> str:
    return f"{n:,} {noun if n == 1 else plural or noun + 's'}"


def capped(df: DataFrame, order: str, cap: int = CAP) -> tuple[list, int]:
    """The first rows in natural order of an address, and how many more there are."""
    return df.orderBy(natural_key(F.col(order)), order).limit(cap).collect(), max(0, df.count() - cap)


def change_report(changes: DataFrame, key: str, before: str, after: str, titles: DataFrame | None = None) -> str:
    """The report of ``operators.changes.compared`` rows (key, status, moved)."""
    named = changes if titles is None else changes.join(titles.select(F.col(key), F.col("title")), key, "left")
    counts = {r["status"]: r["n"] for r in changes.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    lines = [f"# Changes from {before} to {after}", ""]
    moved = {k: n for k, n in counts.items() if k != "unchanged"}
    if not moved:
        return "\n".join([*lines, "Nothing changed.", ""])
    lines += [", ".join(counted(moved[k], f"page {k}", f"pages {k}") for k in sorted(moved)) + f"; {counted(counts.get('unchanged', 0), 'page')} unchanged.", ""]
    for status in ("added", "restored", "amended", "reworded", "retired", "vanished"):
        if status not in moved:
            continue
        rows, more = capped(named.where(F.col("status") == status).withColumn("_moved", escaped_cell(F.col("moved"))), key)
        lines += [f"## {status.capitalize()}", ""]
        if status in ("amended", "reworded"):
            lines += ["| Page | Fields moved |", "| --- | --- |", *[f"| {r[key]} | {r['_moved'] or '-'} |" for r in rows]]
        else:
            lines += [f"- {r[key]}" + (f" {r['title']}" if titles is not None and r["title"] else "") for r in rows]
        lines += [f"… and {more:,} more", ""] if more else [""]
    return "\n".join(lines)


def run_report(counters: dict[str, int], unreachable: DataFrame) -> str:
    """Counts of a run and the pages that couldn't be reached."""
    rows, more = capped(unreachable, "url")
    lines = ["# Run", "", *[f"- {name.replace('_', ' ')}: {n:,}" for name, n in counters.items()], ""]
    if rows:
        lines += ["## Unreachable", "", *[f"- {r['url']} ({r['status']})" for r in rows], *([f"… and {more:,} more"] if more else []), ""]
    return "\n".join(lines)


#: Sections in the order of a report, with their titles.
SECTIONS = {
    "parts": "Parts", "addresses": "Addresses that tell another page", "amended": "Amended", "silent": "Amended without a word in the log", "added": "Added", "restored": "Restored", "retired": "Retired",
    "vanished": "Gone without being retired", "reworded": "Changed around the text", "rebuilt": "Made by another version", "unreachable": "Unreachable",
}


def change_rows(compared: dict[str, DataFrame], key: str = "page_ref", part: str = "part_id", url: str = "url", version: str = "extractor_version") -> DataFrame:
    """(section, key, detail) of all that ``settling.compared_corpora`` found, or the like: pages, parts, readdressed and silent. What hasn't moved has no row."""
    status = F.when((F.col("status") == "reworded") & (F.col("moved") == version), "rebuilt").otherwise(F.col("status"))
    pages = compared["pages"].where("status <> 'unchanged'").select(status.alias("section"), F.col(key).alias("key"), F.col("moved").alias("detail"))
    parts = compared["parts"].where("status <> 'unchanged'").select(F.lit("parts").alias("section"), F.col(part).alias("key"), F.col("status").alias("detail"))
    places = F.concat(F.coalesce("was", F.lit("-")), F.lit(" → "), F.coalesce("now", F.lit("-")))
    urls = compared["readdressed"].select(F.lit("addresses").alias("section"), F.col(url).alias("key"), places.alias("detail"))
    silent = compared["silent"].select(F.lit("silent").alias("section"), F.col(key).alias("key"), F.lit("").alias("detail"))
    return pages.unionByName(parts).unionByName(urls).unionByName(silent)


def first_rows(rows: DataFrame, cap: int = CAP) -> DataFrame:
    """(section, place, total, key, detail): the first ``cap`` rows of each section in natural order of their key, and how many rows the section has.

    Each task keeps no more than ``cap`` rows a section before they are shuffled, so a section that holds most rows is no hot group.
    """
    order = Window.partitionBy("section").orderBy(natural_key(F.col("key")), "key", "detail")
    shown = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap)
    totals = rows.groupBy("section").agg(F.count(F.lit(1)).alias("total"))  # a row a section
    return shown.join(F.broadcast(totals), "section").select("section", "place", "total", "key", "detail")


def corpus_report(before: Corpus, after: Corpus, names: tuple[str, str] = ("before", "after"), unreachable: DataFrame | None = None, cap: int = CAP) -> str:
    """The whole report between two snapshots: headline, a section for each kind of change, pages that couldn't be reached (url, status).

    ``cap`` bounds the rows of a section that are shown, never those counted. A snapshot without pages before it gets a list of its parts in place of a comparison.
    Chunks are compared for shown pages only.
    """
    live = after.pages.where("not retired")
    if before.pages.isEmpty():
        parts = live.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))
        rows, more = capped(parts, "part_id", cap)
        lines = [f"# First snapshot: {names[1]}", "", f"{counted(live.count(), 'page')} in {counted(len(rows) + more, 'part')}; nothing to compare with.", "", "| Part | Pages |", "| --- | --- |"]
        return "\n".join([*lines, *[f"| {r['part_id']} | {r['n']:,} |" for r in rows], *([f"… and {more:,} more"] if more else []), ""])
    found = settling.compared_corpora(before, after)
    rows = change_rows(found)
    if unreachable is not None:
        rows = rows.unionByName(unreachable.select(F.lit("unreachable").alias("section"), F.col("url").alias("key"), F.col("status").cast("string").alias("detail")))
    shown: dict[str, list] = {}
    for r in first_rows(rows, cap).orderBy("section", "place").collect():  # cap rows a section at most
        shown.setdefault(r["section"], []).append(r)
    same = found["pages"].where("status = 'unchanged'").count()
    told = [f"{counted(shown[x][0]['total'], 'page')} {x}" for x in SECTIONS if x in shown and x not in ("parts", "addresses", "silent", "unreachable")]
    lines = [f"# Changes from {names[0]} to {names[1]}", "", ", ".join(told or ["Nothing changed"]) + f"; {counted(same, 'page')} unchanged.", ""]
    edits = _edits(before, after, [r["key"] for r in shown.get("amended", [])])
    for section, title in SECTIONS.items():
        if section not in shown:
            continue
        total, cell = shown[section][0]["total"], lambda x: (x or "-").replace("|", "\\|")
        lines += [f"## {title} ({total:,})", ""]
        if section == "amended":
            lines += ["| Page | Chunks edited | Added | Removed | Of | Fields moved |", "| --- | --- | --- | --- | --- | --- |"]
            lines += [f"| {r['key']} | {' | '.join(f'{n:,}' for n in edits.get(r['key'], (0, 0, 0, 0)))} | {cell(r['detail'])} |" for r in shown[section]]
        else:
            lines += [f"- {r['key']}" + (f": {r['detail']}" if r["detail"] else "") for r in shown[section]]
        lines += [f"… and {total - cap:,} more", ""] if total > cap else [""]
    return "\n".join(lines)


def _edits(before: Corpus, after: Corpus, pages: list[str]) -> dict[str, tuple[int, int, int, int]]:
    """Chunks edited, added, removed and now held of the pages that a report shows."""
    if not pages:
        return {}
    was, now = (c.chunks.where(~F.col("retired") & F.col("page_ref").isin(pages)) for c in (before, after))
    return {r["page_ref"]: (r["edited"], r["added"], r["removed"], r["total"]) for r in moves.part_changes(was, now, "page_ref", "chunk_ref", "content_hash").collect()}
