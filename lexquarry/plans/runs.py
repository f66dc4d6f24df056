"""Registered queries of runs over an existing snapshot and of the rules on units, each with SQL over the same tables.

Orders stand for fetched pages and citing chunks, customers for versions, conversation turns for units.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import runs, settling, structure
from ..sources.publish import Store, shared_folder
from ..sources.snapshot import canonical_json
from .catalog import query

_STATUS = "case when o_custkey % 5 < 2 then 304 when o_custkey % 11 = 0 then 404 else 200 end"


@query(f"""
with a as (select o_orderkey as k, {_STATUS} as status, case when o_orderkey % 9 <> 0 then o_orderpriority end as html,
   exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 45) as record, exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity < 20) as raw from orders)
select k, case when status = 200 and html is not null then 'parse' when status = 304 and record then 'skip' when status = 304 and raw then 'reread' when status = 304 then 'failed' else 'unreachable' end as gate from a""")
def fetch_gates(read):
    answers = read("orders").select(F.col("o_orderkey").alias("k"), F.expr(_STATUS).alias("status"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("html"))
    held = read("lineitem", F.col("l_orderkey").alias("k"), "l_quantity")
    return settling.fetch_gate(answers, held.where("l_quantity > 45"), held.where("l_quantity < 20"), "k").select("k", "gate")


@query("""
select c_custkey as code, case when c_custkey % 3 = 0 then 'new' when c_custkey % 5 = 0 or c_nationkey % 4 = 0 and c_custkey % 7 = 0 then 'moved' else 'unchanged' end as gate from customer""")
def version_gates(read):
    rows = read("customer", F.col("c_custkey").alias("code"), "c_nationkey")
    stored = rows.where("code % 3 <> 0").select("code", F.expr("if(c_nationkey % 4 = 0, null, c_nationkey)").alias("version"))
    offered = rows.select("code", F.expr("case when code % 5 = 0 then c_nationkey + 1 when c_nationkey % 4 <> 0 or code % 7 = 0 then c_nationkey end").alias("version"))
    return settling.version_gate(stored, offered, "code", "version").select("code", "gate")


@query("""
select conv_id || '/' || turn as ref from conversations where conv_id % 3 <> 0
union select conv_id || '/' || turn || 'a' from conversations where conv_id % 3 = 0 and turn < 3""")
def finished_inventory(read):
    """Every third conversation is cut anew, with its first turns only."""
    rows = read("conversations", "conv_id", "turn")
    stored, again = rows.select("conv_id", F.concat_ws("/", "conv_id", "turn").alias("ref")), rows.where("conv_id % 3 = 0")
    cut = again.where("turn < 3").select("conv_id", F.concat(F.concat_ws("/", "conv_id", "turn"), F.lit("a")).alias("ref"))
    return settling.finished_inventory(again, cut, stored, "conv_id", "ref")


_REF = "concat('M/P', l_suppkey % 9, '/', l_partkey % 20, '/', l_orderkey % 5)"
_PAGE = "concat('M/P', p_size % 9, '/', p_partkey % 20)"


@query(f"""
with s as (select l_orderkey as k, {_REF} as ref, case when l_linestatus = 'F' then 'href' else 'regex' end as extraction, concat('M/P', l_suppkey % 9, '/', l_partkey % 20) as up from lineitem),
 p as (select distinct {_PAGE} as ref from part where p_size > 10),
 c as (select {_PAGE} || '/' || p_size % 5 as ref from part where p_size % 2 = 0 union select {_PAGE} || '/' || p_size % 5 || '~1' from part where p_size % 3 = 0),
 b as (select distinct k, ref, extraction from s),
 t as (select k, extraction, case when ref in (select ref from c) then ref when ref || '~1' in (select ref from c) then ref || '~1' when up in (select ref from p) then up end as ref from s),
 a as (select k, ref, min(extraction) as extraction from t where ref is not null group by 1, 2)
select k, ref, extraction, 'added' as change from (select k, ref, extraction from a except select k, ref, extraction from b)
union all select k, ref, extraction, 'dropped' from (select k, ref, extraction from b except select k, ref, extraction from a)""")
def resettled_refs(read):
    extraction = F.when(F.col("l_linestatus") == "F", "href").otherwise("regex")
    stored = read("lineitem").select(F.col("l_orderkey").alias("k"), F.expr(_REF).alias("ref"), extraction.alias("extraction"), F.lit("").alias("mention"), F.col("l_linenumber").alias("seq"))
    part = read("part", "p_partkey", "p_size")
    whole = part.where("p_size % 2 = 0").select(F.expr(f"concat({_PAGE}, '/', p_size % 5)").alias("ref"))
    first = part.where("p_size % 3 = 0").select(F.expr(f"concat({_PAGE}, '/', p_size % 5, '~1')").alias("ref"))
    return settling.resettled(stored, whole.unionByName(first), part.where("p_size > 10").select(F.expr(_PAGE).alias("ref")), "k")


_PARENT = "case when turn % 6 > 1 then turn - turn % 2 - case when turn % 6 < 4 then 2 else 4 end + turn % 2 + 1 end"
_NUMBER = "case when turn % 6 > 1 then concat('(', (turn + conv_id % 3 * (turn % 2)) % 4, ')') end"


@query(f"""
with u as (select conv_id, turn + 1 as ordinal, {_PARENT} as parent, {_NUMBER} as number from conversations)
select b.conv_id, b.ordinal from u b where b.number is null and not exists (
  select 1 from u x join u y on x.conv_id = y.conv_id and x.number = y.number and x.parent <> y.parent
  join u p on p.conv_id = x.conv_id and p.ordinal = x.parent join u q on q.conv_id = y.conv_id and q.ordinal = y.parent
  where x.conv_id = b.conv_id and p.number is null and q.number is null and coalesce(p.parent, 0) = coalesce(b.parent, 0) and coalesce(q.parent, 0) = coalesce(b.parent, 0))""")
def transparent_units(read):
    turns = read("conversations", "conv_id", "turn")
    units = turns.select("conv_id", (F.col("turn") + 1).alias("ordinal"), F.expr(_PARENT).alias("parent"), F.expr(_NUMBER).alias("number"), F.lit(None).cast("string").alias("term"))
    return structure.transparent(units, "conv_id")


_BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+"


@query(rf"""
with d as (select doc_id, text, unnest([0, length(text) // 3, length(text) // 2]) as a, unnest([least(9, length(text)), length(text) // 3 + 30, length(text)]) as z from documents where text is not null),
 w as (select doc_id, trim(regexp_replace(substr(text, a + 1, z - a), '{_BLANK}', ' ', 'g')) as words, length(ltrim(regexp_replace(left(text, a), '{_BLANK}', ' ', 'g') || '|')) as p,
   length(regexp_extract(substr(text, a + 1, z - a), '^{_BLANK.replace('+', '*')}')) as lead, right(regexp_replace(left(text, a), '{_BLANK}', ' ', 'g'), 1) = ' ' or length(ltrim(regexp_replace(left(text, a), '{_BLANK}', ' ', 'g'))) = 0 as blank from d)
select doc_id, sha256(words) as words, cast(p - 1 + case when lead > 0 and not blank then 1 else 0 end as integer) as start, cast(p - 1 + case when lead > 0 and not blank then 1 else 0 end + length(words) as integer) as stop from w where words <> ''""")
def rebased_spans(read):
    """Three spans of every text: its beginning, thirty characters from a third on, and its second half."""
    n = F.length("text")
    span = lambda a, z: F.struct(F.substring("text", a + 1, z - a).alias("text"), a.cast("int").alias("start"), z.cast("int").alias("end"), F.lit("bold").alias("weight"))
    third, half = F.floor(n / 3), F.floor(n / 2)
    docs = read("documents", "doc_id", "text").where("text is not null").select("doc_id", "text", F.array(span(F.lit(0), F.least(F.lit(9), n)), span(third, third + 30), span(half, n)).alias("spans"))
    return docs.select("doc_id", F.inline(structure.rebased(F.col("text"), F.col("spans")))).select("doc_id", F.sha2("text", 256).alias("words"), "start", F.col("end").alias("stop"))


_NEUTRAL, _REPORT = "concat('[20', lpad(cast(c_nationkey as {s}), 2, '0'), '] FCA ', c_custkey % 99)", "concat('(1954) ', c_nationkey + 1, ' RPC ', c_custkey % 50)"


@query(f"""
with c as (select c_custkey as k, {_NEUTRAL.format(s="varchar")} as n, {_REPORT} as r, concat(c_nationkey + 1, ' IPR ', c_custkey % 7) as s from customer)
select k, n as citation, r as parallel, 'r' || k as parallel_id from c union all select k, r, n, 'n' || k from c where k % 2 = 0
union all select k, r, n, 'n' || k from c where k % 2 = 1""")
def parallel_decisions(read):
    """A decision by its court, by its report, and by another report without a year; of three in a row the first two pair."""
    rows = read("customer").select(F.col("c_custkey").alias("k"), F.expr(_NEUTRAL.format(s="string")).alias("n"), F.expr(_REPORT).alias("r"), F.expr("concat(c_nationkey + 1, ' IPR ', c_custkey % 7)").alias("s"))
    docs = rows.select("k", F.concat(F.lit("see "), "n", F.lit("; "), "r", F.when(F.col("k") % 2 == 0, F.lit(", ")).otherwise(F.lit(" and ")), "s").alias("text"))
    cases = rows.select("k", F.inline(F.array(F.struct(F.col("n").alias("citation"), F.concat(F.lit("n"), "k").alias("id")), F.struct(F.col("r").alias("citation"), F.concat(F.lit("r"), "k").alias("id")))))
    return structure.parallel_citations(docs, cases, "k", "text")


@query("""
select p_partkey, 'sha256:' || sha256('{"a":{"n":' || p_size || ',"z":' || to_json(p_brand) || '},"m":{"k":' || to_json(p_type) || ',"y":' || p_partkey || '},"p_partkey":' || p_partkey || '}') as digest
from (select p_partkey, p_size, p_brand, cast(p_partkey % 7 as varchar) as p_type from part)""")
def nested_digest(read):
    """Structs and maps in structs, their fields out of order."""
    rows = read("part").select(
        "p_partkey", F.struct(F.col("p_brand").alias("z"), F.col("p_size").alias("n")).alias("a"), F.struct(F.col("p_partkey").alias("y"), (F.col("p_partkey") % 7).cast("string").alias("k")).alias("m")
    )
    return canonical_json(rows, "p_partkey").select("p_partkey", "digest")


_RUN_REF = "'M/Part' || cast(page_id % 7 as {s}) || '/' || cast(page_id as {s})"


@query(f"""
with p as (select page_id, {_RUN_REF.format(s="varchar")} as page_ref, url, coalesce(html, '') as html from pages),
 f as (select page_id, page_ref, page_id % 4 <> 0 and page_id % 9 <> 0 as one, page_id % 9 <> 0 and page_id % 11 <> 0 as nav, page_id % 3 = 0 or page_id % 4 = 0 as read from p)
select page_ref, case when one then 't1' else 't2' end as first_seen, case when one and not (nav and page_id % 3 = 0) then 't1' else 't2' end as crawled_at, case when not nav then 't2' end as retired_at
from f where one or nav and read""")
def published_run(read):
    """Two runs over the landed pages, read back from what they published: the first reads most pages; the second gets a new page, moved ones and 304s, and an inventory that lost some."""
    pages = read("pages", "page_id", F.expr(_RUN_REF.format(s="string")).alias("page_ref"), F.expr("'Part' || page_id % 7").alias("part_id"), F.expr("'http://h/' || page_id").alias("url"), F.expr("coalesce(html, '')").alias("html"))
    store = Store(pages.sparkSession, shared_folder(pages.sparkSession, "published"))
    nav = pages.where("page_id % 9 <> 0")
    runs.carried_out(store, "first", "t1", nav, nav.where("page_id % 4 <> 0").select("url", F.lit(200).alias("status"), "html"))
    store.swept()  # what the run wrote aside
    # Every third page moved; pages of the first run answer 304 else, and those that it hadn't are read if the nav still has them.
    status = F.when((F.col("page_id") % 3 == 0) | (F.col("page_id") % 4 == 0), 200).otherwise(304)
    html = F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit("<p>more</p>"))).otherwise(F.col("html"))
    later = nav.where("page_id % 11 <> 0")
    runs.carried_out(store, "second", "t2", later, later.select("url", status.alias("status"), F.when(status == 200, html).alias("html")))
    store.swept()
    out = store.table("pages", runs.TABLES["pages"]).join(store.table("retired", runs.TABLES["retired"]), "page_ref", "left")
    return out.select("page_ref", "first_seen", "crawled_at", "retired_at")
