"""Every broken invariant of a corpus as rows of (check, where, message): all of them, not the first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digest
from ..sources.snapshot import Corpus


def _rows(df: DataFrame, check: str, where: str, broken: Column, message: str) -> DataFrame:
    return df.where(broken).select(F.lit(check).alias("check"), F.col(where).alias("where"), F.lit(message).alias("message"))


def _span_broken(spans: str) -> Column:
    """A span that lies outside the text or doesn't name its own words."""
    return F.expr(f"exists({spans}, s -> s.start < 0 or s.end < s.start or s.end > length(text) or substring(text, s.start + 1, s.end - s.start) <> s.text)")


def chunk_failures(chunks: DataFrame) -> list[DataFrame]:
    joined = F.expr("array_join(transform(filter(blocks, b -> b.text is not null), b -> b.text), ' ')")
    leaf = F.expr("try_element_at(headings, -1).source")
    return [
        _rows(chunks, "blocks", "chunk_ref", F.col("blocks").isNotNull() & (joined != F.col("text")), "the blocks' text isn't the chunk's"),
        _rows(chunks, "links", "chunk_ref", _span_broken("links"), "a link's offsets don't name its words"),
        _rows(chunks, "emphasis", "chunk_ref", _span_broken("emphasis") | F.expr("exists(emphasis, s -> s.start >= s.end)"), "an emphasis span is empty or names other words"),
        _rows(chunks, "hash", "chunk_ref", F.col("content_hash") != digest(F.col("text")), "the hash isn't the text's"),
        _rows(chunks, "headings", "chunk_ref", F.col("headings").isNotNull() & (F.size("headings") != F.greatest(F.size("heading_path") - 2, F.lit(0))), "headings and heading path differ in number"),
        _rows(chunks, "heading_source", "chunk_ref", (F.size("headings") > 0) & ~leaf.eqNullSafe(F.col("heading_source")), "the leaf heading's source isn't the chunk's"),
        _rows(chunks, "ordinal", "chunk_ref", F.col("ordinal") != F.col("seat") + 1, "ordinals aren't contiguous in the array's order"),
        _rows(chunks, "edges", "chunk_ref", F.expr("size(provisions) <> size(array_distinct(transform(provisions, p -> p.id)))"), "a provision is cited twice"),
    ]


def page_failures(pages: DataFrame, chunks: DataFrame) -> list[DataFrame]:
    refs = pages.select(F.col("page_ref").alias("ref")).unionByName(chunks.select(F.col("chunk_ref").alias("ref")))
    twice = refs.groupBy("ref").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    newest = F.expr("array_sort(amendments, (a, b) -> case when a.date > b.date then -1 when a.date < b.date then 1 else 0 end)")
    head = F.expr("try_element_at(amendments, 1)")
    bad_path = ~F.endswith(F.col("path"), F.concat(F.lit("/"), F.replace(F.col("page_ref"), F.lit("/"), F.lit("-")), F.lit(".json")))
    return [
        _rows(twice, "unique", "ref", F.lit(True), "an address is used twice"),
        _rows(pages, "amendments", "page_ref", F.col("amendments").isNotNull() & (newest != F.col("amendments")), "amendments aren't newest first"),
        _rows(pages, "amended", "page_ref", (F.size("amendments") > 0) & ~(head["date"].eqNullSafe(F.col("last_amended")) & head["reason"].eqNullSafe(F.col("amendment_note"))), "the newest amendment isn't the page's"),
        _rows(pages, "path", "page_ref", bad_path, "the file's name isn't the page's address"),
        _rows(pages, "stamp", "page_ref", ~F.col("crawled_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?(?:Z|[+-]\d\d:\d\d)$"), "the stamp has no zone"),
    ]


def reference_failures(pages: DataFrame, chunks: DataFrame, nav: DataFrame) -> list[DataFrame]:
    known = pages.select(F.col("page_ref").alias("ref")).unionByName(chunks.select(F.col("chunk_ref").alias("ref"))).unionByName(nav.select(F.col("page_ref").alias("ref"))).distinct()
    inner = chunks.select(F.col("chunk_ref").alias("where"), F.explode("internal_refs.ref").alias("ref"))
    heads = chunks.select(F.col("chunk_ref").alias("where"), F.explode("headings.ref").alias("ref")).where("ref is not null")
    lost = inner.unionByName(heads).join(known, "ref", "left_anti")
    return [lost.select(F.lit("reference").alias("check"), "where", F.concat(F.lit("nothing has the address "), "ref").alias("message"))]


def unit_failures(provisions: DataFrame, units: DataFrame) -> list[DataFrame]:
    joined = F.expr("array_join(transform(units, u -> u.text), ' ')")
    same = F.count(F.lit(1)).over(Window.partitionBy("provision", "parent_ref", "number"))
    flagged = units.withColumn("_same", same)
    parents = units.select(F.col("provision").alias("_p"), F.col("ref").alias("_ref"))
    orphans = units.where("parent_ref is not null").join(parents, (F.col("provision") == F.col("_p")) & (F.col("parent_ref") == F.col("_ref")), "left_anti")
    refs = provisions.select("ref").unionByName(units.select("ref"))
    twice = refs.groupBy("ref").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return [
        _rows(provisions, "units", "ref", joined != F.col("text"), "the units' text isn't the provision's"),
        _rows(provisions, "hash", "ref", F.col("content_hash") != digest(F.col("text")), "the hash isn't the text's"),
        _rows(units, "ordinal", "ref", F.col("ordinal") != F.col("seat") + 1, "ordinals aren't contiguous in the array's order"),
        _rows(flagged, "collision", "ref", F.col("number").isNotNull() & (F.coalesce("number_collision", F.lit(False)) != (F.col("_same") > 1)), "the collision flag doesn't tell whether siblings share the number"),
        _rows(orphans, "parent", "ref", F.lit(True), "the parent isn't a unit of the provision"),
        _rows(twice, "unique", "ref", F.lit(True), "an address is used twice"),
    ]


def contents_failures(contents: DataFrame, provisions: DataFrame) -> list[DataFrame]:
    listed = contents.select(F.explode("provisions.ref").alias("ref"))
    return [
        _rows(listed.join(provisions.select("ref"), "ref", "left_anti"), "contents", "ref", F.lit(True), "listed, but there is no file"),
        _rows(provisions.select("ref").join(listed, "ref", "left_anti"), "contents", "ref", F.lit(True), "a file, but not listed"),
    ]


def failures(corpus: Corpus) -> DataFrame:
    """All failures of a snapshot: unreadable files, then the checks of pages, chunks, references and units."""
    corrupt = corpus.corrupt.select(F.lit("file").alias("check"), F.col("path").alias("where"), F.lit("not a page file").alias("message"))
    pages, chunks, units = corpus.pages, corpus.chunks, corpus.units
    checks = [corrupt, *chunk_failures(chunks), *page_failures(pages, chunks), *reference_failures(pages, chunks, corpus.nav), *unit_failures(corpus.provisions, units), *contents_failures(corpus.contents, corpus.provisions)]
    return reduce(DataFrame.unionByName, checks)


def coverage(edges: DataFrame, known: DataFrame, codes: list[str]) -> DataFrame:
    """One row: edges, those of the instruments in scope, and those whose provision or unit exists."""
    held = known.select(F.col("ref").alias("_ref")).distinct()
    scope = F.substring_index("id", "/", 1).isin(codes)
    joined = edges.join(held, F.col("id") == F.col("_ref"), "left")
    return joined.agg(F.count(F.lit(1)).alias("total"), F.count_if(scope).alias("in_scope"), F.count_if(scope & F.col("_ref").isNotNull()).alias("resolved"))
