"""The flat export of decisions: one row for each decision that a passage cites, with the words around it and who says what it is called.

All that a row needs stands in its passage, so it is worked out within the passage's row and the text is neither joined nor
copied for each of its decisions; only the count of a decision over the corpus is a grouping, and that is joined back.

Edge cases: passages without text or cases give no row; absent links, emphasis and paths are empty; of links that hold the citation, and of
pairs printed side by side, the first counts; of emphasised runs the longest, of equal ones the first. A citation that isn't in its passage, or
of neither shape, raises, or has nulls where it isn't ``strict``; ``errors`` has such rows in either case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .structure import PAIR

# The shapes of a citation, what may stand between a name and its citation, what is stripped from names, and the columns in their order.
NEUTRAL = r"(?U)^\[(\d{4})\]\s+([A-Za-z]+)\s+(\d+)$"
REPORTED = r"(?U)^\((\d{4})\)\s+(\d+)\s+([A-Za-z]+)\s+(\d+)$"
BETWEEN = r"(?U)^[\s,;:(]*$"
REACH, CONTEXT = 3, 140
STRIPPED = " .,;:-"
HOST = "jade.io"
COLUMNS = [
    "case_id", "citation", "citation_style", "year", "court_or_series", "number", "volume", "first_page", "corpus_citation_count", "parties", "parties_source", "jade_href",
    "parallel_citation", "parallel_case_id", "chunk_ref", "page_ref", "part_id", "part_title", "page_title", "heading_path", "chunk_ordinal", "char_offset", "occurrences_in_chunk", "url", "context",
]
ORDER = ["year", "citation", "chunk_ref"]


def _parsed(citation: Column) -> list[Column]:
    """Style, year, court or series, number, volume and first page; all null for a shape that is neither."""
    part = lambda pattern, i: F.regexp_extract(citation, pattern, i)
    neutral, reported = citation.rlike(NEUTRAL), citation.rlike(REPORTED)
    either = lambda a, b: F.when(neutral, a).when(reported, b)
    return [
        either(F.lit("neutral"), F.lit("reported")).alias("citation_style"), either(part(NEUTRAL, 1), part(REPORTED, 1)).cast("int").alias("year"),
        either(part(NEUTRAL, 2), part(REPORTED, 3)).alias("court_or_series"), either(part(NEUTRAL, 3), F.lit("")).alias("number"),
        either(F.lit(""), part(REPORTED, 2)).alias("volume"), either(F.lit(""), part(REPORTED, 4)).alias("first_page"),
    ]


def _told_by_emphasis(text: Column, spans: Column, offset: Column) -> Column:
    near = lambda s: s["kind"].isin("i", "em") & (s["end"] <= offset) & (s["end"] >= offset - REACH) & F.substring(text, s["end"] + 1, offset - s["end"]).rlike(BETWEEN)
    ranked = F.transform(F.filter(spans, near), lambda s, i: F.struct((s["end"] - s["start"]).alias("n"), (-i).alias("first"), s["text"].alias("text")))
    return F.coalesce(F.btrim(F.array_max(ranked)["text"], F.lit(STRIPPED + "(")), F.lit(""))


def _row(text: Column, cases: Column, links: Column, spans: Column, pairs: Column, case: Column) -> Column:
    citation = case["citation"]
    offset = F.nullif(F.instr(text, citation), F.lit(0)) - 1
    link = F.get(F.filter(links, lambda x: F.contains(x["text"], citation)), F.lit(0))
    anchor = F.coalesce(F.btrim(F.substring(link["text"], F.lit(1), F.instr(link["text"], citation) - 1), F.lit(STRIPPED)), F.lit(""))
    told = _told_by_emphasis(text, spans, offset)
    beside = F.get(F.filter(pairs, lambda p: (p["a"] == citation) | (p["b"] == citation)), F.lit(0))
    other = F.coalesce(F.when(beside["a"] == citation, beside["b"]).otherwise(beside["a"]), F.lit(""))
    same = F.filter(cases, lambda c: c["citation"] == other)
    start = F.greatest(F.lit(0), offset - CONTEXT)
    return F.struct(
        case["id"].alias("case_id"), citation.alias("citation"), *_parsed(citation),
        F.when(anchor != "", anchor).otherwise(told).alias("parties"), F.when(anchor != "", "anchor").when(told != "", "emphasis").otherwise("").alias("parties_source"),
        F.when(F.contains(F.lower(link["href"]), F.lit(HOST)), link["href"]).otherwise("").alias("jade_href"),
        other.alias("parallel_citation"), F.coalesce(F.get(same, F.size(same) - 1)["id"], F.lit("")).alias("parallel_case_id"), offset.alias("char_offset"),
        ((F.length(text) - F.length(F.replace(text, citation, F.lit("")))) / F.nullif(F.length(citation), F.lit(0))).cast("int").alias("occurrences_in_chunk"),
        F.substring(text, start + 1, F.least(F.length(text), offset + F.length(citation) + CONTEXT) - start).alias("context"),
    )


def _positions(chunks: DataFrame) -> DataFrame:
    pairs = F.transform(F.regexp_extract_all("text", F.lit("(?U)" + PAIR), F.lit(0)), lambda p: F.struct(F.regexp_extract(p, "(?U)" + PAIR, 1).alias("a"), F.regexp_extract(p, "(?U)" + PAIR, 2).alias("b")))
    held = chunks.where("size(cases) > 0 and text is not null").withColumn("_pairs", pairs)
    of = [F.col(c) for c in ("text", "cases", "links", "emphasis", "_pairs")]
    names = ["chunk_ref", "page_ref", "part_id", F.coalesce(F.get("heading_path", F.lit(0)), F.lit("")).alias("part_title"), F.coalesce(F.array_join("heading_path", " > "), F.lit("")).alias("heading_path"), F.col("ordinal").alias("chunk_ordinal")]
    return held.select(*names, F.inline(F.transform("cases", lambda c: _row(*of, c))))


def _fault() -> Column:
    """What is wrong with a row, or null."""
    return F.when(F.col("char_offset").isNull(), F.format_string("'%s' not in %s", "citation", "chunk_ref")).when(F.col("citation_style").isNull(), F.format_string("unparsed citation '%s' on %s", "citation", "case_id"))


def errors(chunks: DataFrame) -> DataFrame:
    """(kind, key, message) of the citations that aren't in their passage or have neither shape."""
    return _positions(chunks).select(F.lit("ValueError").alias("kind"), F.col("chunk_ref").alias("key"), _fault().alias("message")).where("message is not null")


def positions(chunks: DataFrame, pages: DataFrame, strict: bool = True) -> DataFrame:
    """The export's ``COLUMNS``. ``chunks`` has (chunk_ref, page_ref, part_id, ordinal, text, heading_path, cases, links, emphasis), ``pages`` (page_ref, h1, nav_title, url)."""
    found = _positions(chunks)
    if strict:
        found = found.withColumn("citation", F.when(_fault().isNotNull(), F.raise_error(_fault()).cast("string")).otherwise(F.col("citation")))
    counts = found.groupBy("case_id").agg(F.count(F.lit(1)).alias("corpus_citation_count"))
    titles = pages.select("page_ref", "url", F.coalesce(F.nullif("h1", F.lit("")), "nav_title").alias("page_title"))
    return found.join(counts, "case_id").join(titles, "page_ref", "left").select(*COLUMNS)
