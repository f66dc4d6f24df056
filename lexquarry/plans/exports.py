"""Registered queries of what people read: the case export (documents that cite decisions, in two shapes side by side) and the sections of a change report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes, export, report, views
from .catalog import query

_NAME = "concat('A', doc_id, ' v ', coalesce(source, 'B'))"
_NEUTRAL = "concat('[', 1990 + doc_id % 30, '] FCA ', doc_id % 17 + 1)"
_REPORTED = "concat('(', 1990 + doc_id % 30, ') ', doc_id % 9 + 1, ' CLR ', doc_id % 23 + 1)"
_TEXT = f"concat('In ', {_NAME}, ' ', {_NEUTRAL}, ', ', {_REPORTED}, '. ', coalesce(text, ''), case when doc_id % 4 = 0 then concat(' See ', {_NEUTRAL}, '.') else '' end)"
_CASE = "concat('CASE/', translate({c}, '[]() ', '////_'))"


@query(f"""
with d as (select doc_id, {_NAME} as name, {_NEUTRAL} as nc, {_REPORTED} as rc, {_TEXT} as t, 1990 + doc_id % 30 as year from documents where doc_id is not null),
 r as (
  select *, nc as c, 'neutral' as citation_style, 'FCA' as court_or_series, cast(doc_id % 17 + 1 as varchar) as number, '' as volume, '' as first_page, rc as parallel_citation,
   case when doc_id % 2 = 0 then {_CASE.format(c="rc")} else '' end as parallel_case_id, 4 + length(name) as pos, case when doc_id % 5 = 0 then 'anchor' when doc_id % 3 = 0 then 'emphasis' else '' end as parties_source,
   case when doc_id % 5 = 0 and doc_id % 2 = 0 then 'https://JADE.io/a' else '' end as jade_href, case when doc_id % 4 = 0 then 2 else 1 end as occurrences_in_chunk from d
  union all
  select *, rc, 'reported', 'CLR', '', cast(doc_id % 9 + 1 as varchar), cast(doc_id % 23 + 1 as varchar), nc, {_CASE.format(c="nc")}, 6 + length(name) + length(nc), '', '', 1 from d where doc_id % 2 = 0)
select {_CASE.format(c="c")} as case_id, c as citation, citation_style, cast(year as int) as year, court_or_series, number, volume, first_page,
 count(*) over (partition by {_CASE.format(c="c")}) as corpus_citation_count, case when parties_source = '' then '' else name end as parties, parties_source, jade_href, parallel_citation, parallel_case_id,
 concat('D/', doc_id) as chunk_ref, concat('P/', doc_id % 50) as page_ref, concat('Part', doc_id % 7) as part_id, concat('Title ', doc_id % 7) as part_title, p.title as page_title,
 case when doc_id % 3 = 0 then concat('Title ', doc_id % 7) else concat('Title ', doc_id % 7, ' > Heading') end as heading_path, cast(doc_id % 11 as int) as chunk_ordinal, cast(pos as int) as char_offset,
 cast(occurrences_in_chunk as int) as occurrences_in_chunk, p.url, substring(t, greatest(pos - 140, 0) + 1, least(length(t), pos + length(c) + 140) - greatest(pos - 140, 0)) as context
from r left join (select page_id, url, case when page_id % 2 = 0 then concat('H ', page_id) else concat('N ', page_id) end as title from pages) p on p.page_id = doc_id % 50""")
def citation_export(read):
    """Whole texts, citing one decision each by its court and every other also by its report; a third in italics, a fifth linked."""
    docs = read("documents").where("doc_id is not null").selectExpr("doc_id", f"{_NAME} as name", f"{_NEUTRAL} as nc", f"{_REPORTED} as rc", f"{_TEXT} as text")
    case = lambda c: f"struct({_CASE.format(c=c)} as id, {c} as citation)"
    chunks = docs.selectExpr(
        "concat('D/', doc_id) as chunk_ref", "concat('P/', doc_id % 50) as page_ref", "concat('Part', doc_id % 7) as part_id", "cast(doc_id % 11 as int) as ordinal", "text",
        "if(doc_id % 3 = 0, array(concat('Title ', doc_id % 7)), array(concat('Title ', doc_id % 7), 'Heading')) as heading_path",
        f"if(doc_id % 2 = 0, array({case('nc')}, {case('rc')}), array({case('nc')})) as cases",
        "if(doc_id % 5 = 0, array(struct('https://else.example/b' as href, 'elsewhere' as text), struct(if(doc_id % 2 = 0, 'https://JADE.io/a', 'https://else.example/a') as href, concat(name, ', ', nc, '; ', rc) as text)), null) as links",
        "array(struct(if(doc_id % 3 = 0, 'i', 'strong') as kind, name as text, 3 as start, cast(3 + length(name) as int) as end), struct('em' as kind, 'A' as text, 3 as start, 4 as end)) as emphasis",
    ).withColumn("links", F.when(F.size("cases") == 1, F.col("links")).otherwise(F.transform("links", lambda x: F.struct(x["href"].alias("href"), F.regexp_replace(x["text"], "; .*", "").alias("text")))))
    pages = read("pages", "page_id", "url").selectExpr("concat('P/', page_id) as page_ref", "if(page_id % 2 = 0, concat('H ', page_id), '') as h1", "concat('N ', page_id) as nav_title", "url")
    return export.positions(chunks, pages)


@query("""
with p as (select o_orderkey as k, case when o_orderkey % 13 = 3 then 'added' when o_orderkey % 17 = 3 then 'vanished' when o_orderkey % 7 = 0 then 'amended' when o_orderkey % 11 = 0 then 'reworded' when o_orderkey % 5 = 0 then 'rebuilt' end as section,
   concat_ws(',', case when o_orderkey % 11 = 0 then 'title' end, case when o_orderkey % 5 = 0 then 'version' end) as moved from orders where o_orderkey % 13 <> 3 or o_orderkey % 17 <> 3),
 r as (
  select section, k, 'O/' || k as key, case when section in ('added', 'vanished') then '' else moved end as detail from p where section is not null
  union all select 'silent', k, 'O/' || k, '' from p where section = 'amended' and k % 14 <> 0
  union all select 'addresses', s_suppkey, 'u/' || s_suppkey, s_name || ' → ' || s_name || '*' from supplier where s_suppkey % 9 = 0
  union all select 'parts', n_nationkey, 'Part' || n_nationkey, case when n_nationkey % 6 = 5 then 'removed' when n_nationkey % 8 = 7 then 'added' else concat_ws(',', case when n_nationkey % 3 = 0 then 'renamed' end, case when n_nationkey % 4 = 0 then 'resized' end) end
   from nation where (n_nationkey % 6 = 5 or n_nationkey % 8 = 7 or n_nationkey % 3 = 0 or n_nationkey % 4 = 0) and (n_nationkey % 6 <> 5 or n_nationkey % 8 <> 7))
select section, cast(row_number() over (partition by section order by k) as int) as place, count(*) over (partition by section) as total, key, detail from r qualify place <= 40""")
def change_sections(read):
    """Two states of the orders as pages, of suppliers as addresses and of nations as parts: what a report of their changes shows. The cap of a section is the report's."""
    orders = read("orders", "o_orderkey", "o_orderstatus", "o_orderpriority").withColumn("ref", F.concat(F.lit("O/"), "o_orderkey"))
    state = "ref", "o_orderstatus as body", "o_orderpriority as title", "1 as version", "o_orderkey % 2 as log"
    was = orders.where("o_orderkey % 13 <> 3").selectExpr(*state)
    moved = "ref", "if(o_orderkey % 7 = 0, o_orderstatus || '*', o_orderstatus) as body", "if(o_orderkey % 11 = 0, o_orderpriority || '*', o_orderpriority) as title", "if(o_orderkey % 5 = 0, 2, 1) as version", "if(o_orderkey % 14 = 0, -1, o_orderkey % 2) as log"
    now = orders.where("o_orderkey % 17 <> 3").selectExpr(*moved)
    nations = read("nation", "n_nationkey", "n_name").selectExpr("n_nationkey as k", "'Part' || n_nationkey as part_id", "n_name as title", "n_nationkey as n")
    parts = nations.where("k % 8 <> 7"), nations.where("k % 6 <> 5").selectExpr("part_id", "if(k % 3 = 0, title || '*', title) as title", "if(k % 4 = 0, n + 1, n) as n")
    urls = read("supplier", "s_suppkey", "s_name").selectExpr("'u/' || s_suppkey as url", "s_name as ref", "if(s_suppkey % 9 = 0, s_name || '*', s_name) as now")
    found = {
        "pages": changes.compared(was, now, "ref", "body", ["title", "version"]), "parts": views.part_diff(*parts, "part_id"), "silent": views.silent_amendments(was, now, "ref", "body", "log"),
        "readdressed": views.readdressed(urls.select("url", "ref"), urls.select("url", F.col("now").alias("ref")), "url", "ref"),
    }
    return report.first_rows(report.change_rows(found, "ref", version="version"))
