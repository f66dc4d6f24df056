"""Registered queries of the viewer relations, of search and of bundles, each with SQL over the same tables.

``documents`` stand for passages (their source for the part), conversation turns for a page's chunks,
orders and line items for provisions and units.
"""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import bundle, changes, graph, relations, search, validate, views
from .catalog import _BLOCKS_SQL, _GRAPH_SQL, _STATES_SQL, _blocks, _graph, _states, query


@query(f"""
with {_BLOCKS_SQL}, b as (select doc_id, pos, s as b_start, s + length(block) as b_stop from (
    select doc_id, pos, block, coalesce(sum(length(block) + 1) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) as s from blocks)),
 t as (select doc_id, unnest(p) as piece, generate_subscripts(p, 1) as i, len(p) as n from (select doc_id, string_split(lower(text), 'the') as p from documents)),
 h as (select doc_id, i, n, sum(length(piece) + 3) over (partition by doc_id order by i) as stop from t)
select h.doc_id, cast(b.pos as bigint) as pos, cast(h.stop - 3 - b_start as bigint) as start, cast(h.stop - b_start as bigint) as stop
from h join b on h.doc_id = b.doc_id and i < n and b_start <= h.stop - 3 and h.stop <= b_stop""")
def spans_in_blocks(read):
    placed = relations.starts(_blocks(read), "doc_id", "pos", "block").select("doc_id", "pos", F.col("start").alias("b_start"), (F.col("start") + F.length("block")).alias("b_stop"))
    return views.spans_in_blocks(views.highlights(read("documents", "doc_id", "text"), "doc_id", "text", "the"), placed, "doc_id")


@query("""
with t as (select doc_id, unnest(p) as piece, generate_subscripts(p, 1) as i, len(p) as n from (select doc_id, string_split(lower(text), 'on the') as p from documents)),
 h as (select doc_id, i, n, sum(length(piece) + 6) over (partition by doc_id order by i) as stop from t)
select doc_id, cast(stop - 6 as bigint) as start, cast(stop as bigint) as stop from h where i < n""")
def highlight_spans(read):
    return views.highlights(read("documents", "doc_id", "text"), "doc_id", "text", "On the")


@query("""
with c as (select conv_id || '/' || turn as ref, ['' || conv_id || '/0', conv_id || '/' || (turn - turn % 3), conv_id || '/' || (turn + 4)] as h from conversations),
 u as (select ref, unnest(h) as parent, generate_subscripts(h, 1) as i from c)
select c.ref, m.parent from c left join (
  select u.ref, arg_max(u.parent, u.i) as parent from u join (select distinct ref from c) k on u.parent = k.ref where u.parent <> u.ref group by u.ref) m on c.ref = m.ref""")
def chunk_parents(read):
    ref = lambda turn: F.concat_ws("/", "conv_id", turn)
    turn = F.col("turn")
    chunks = read("conversations", "conv_id", "turn").select(ref(turn).alias("ref"), F.array(ref(F.lit(0)), ref(turn - turn % 3), ref(turn + 4)).alias("headings"))
    return views.parents(chunks, "ref", "headings")


def _unit_edges(read) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return read("lineitem").select(F.col("l_orderkey").alias("owner"), F.col("l_linenumber").cast("long").alias("unit"), (F.col("l_suppkey") % 7).alias("id"), F.col("l_linestatus").alias("extraction"), flag.alias("certainty"))


@query("""
select l_orderkey as owner, l_suppkey % 7 as id, l_linestatus as extraction, case when l_returnflag <> 'N' then l_returnflag else '' end as certainty, cast(min(l_linenumber) as bigint) as unit
from lineitem group by 1, 2, 3, 4""")
def first_unit_edges(read):
    return views.first_edges(_unit_edges(read), "owner", "unit").select("owner", "id", "extraction", "certainty", "unit")


@query("select 'certainty' as facet, case when l_returnflag <> 'N' then l_returnflag else 'none' end as value, count(*) as n, row_number() over (order by count(*) desc, case when l_returnflag <> 'N' then l_returnflag else 'none' end) as rank from lineitem group by 2")
def law_facets(read):
    """Before the units' edges are made distinct."""
    return relations.ranked(_unit_edges(read), F.lit("certainty"), "certainty")


_CITED = "select p_brand as owner, case when l_linenumber % 2 = 0 then p_brand || '(' || l_linenumber || ')' else p_brand end as unit, l_orderkey as chunk from lineitem join part on l_partkey = p_partkey"


def _cited(read) -> DataFrame:
    unit = F.when(F.col("l_linenumber") % 2 == 0, F.concat("p_brand", F.lit("("), "l_linenumber", F.lit(")"))).otherwise(F.col("p_brand"))
    rows = read("lineitem", "l_orderkey", "l_partkey", "l_linenumber").join(read("part", "p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(F.col("p_brand").alias("owner"), unit.alias("unit"), F.col("l_orderkey").alias("chunk"))


@query(f"with c as ({_CITED}) select owner, count(distinct chunk) as n_chunks, count(distinct case when unit <> owner then unit end) as n_units from c group by owner")
def cited_by_manual(read):
    return views.citing_manual(_cited(read), "owner", "unit", "chunk")[0]


@query(f"with c as ({_CITED}) select owner, unit, count(distinct chunk) as n_chunks from c where unit <> owner group by all")
def cited_by_manual_units(read):
    return views.citing_manual(_cited(read), "owner", "unit", "chunk")[1]


@query("""
select o_orderpriority, count(*) as n_owners, cast(coalesce(sum(n), 0) as bigint) as n_items, cast(coalesce(sum(m), 0) as bigint) as n_marked
from orders left join (select l_orderkey, count(*) as n, count(*) filter (l_quantity > 40) as m from lineitem where l_linenumber > 1 group by 1) on o_orderkey = l_orderkey group by 1""")
def unit_and_table_counts(read):
    items = read("lineitem", F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity").where("l_linenumber > 1")
    return views.sized(read("orders", "o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority", items, F.col("l_quantity") > 40)


@query("select count(*) as files, cast(sum(octet_length(encode(html))) as bigint) as bytes, cast(round_even(avg(octet_length(encode(html))), 0) as bigint) as mean_bytes from pages")
def corpus_size(read):
    return views.stored_size(read("pages", "html"), F.octet_length("html"))


@query("select l_suppkey, arg_min(l_shipdate, (l_orderkey, l_linenumber, l_shipdate)) as l_shipdate, count(*) as n from lineitem group by 1")
def first_seen_supplier(read):
    return views.first_seen(read("lineitem", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber"), "l_suppkey", "l_shipdate", ["l_orderkey", "l_linenumber"])


@query("select count(*) filter (event_type = 'click') as clicks, count(*) filter (value > 50) as large, count(*) filter (event_type is null) as untyped, count(*) as seen from events")
def run_counters(read):
    kind = F.col("event_type")
    return views.counters(read("events", "event_type", "value"), {"clicks": kind == "click", "large": F.col("value") > 50, "untyped": kind.isNull(), "seen": F.lit(True)})


@query("""
select conv_id, turn, cast(coalesce(sum(case when length(t) > 0 then length(t) + 1 else 0 end) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as bigint) as start
from (select conv_id, turn, case when role = 'system' then '' else text end as t from conversations)""")
def table_cell_starts(read):
    cells = read("conversations").select("conv_id", "turn", F.when(F.col("role") == "system", "").otherwise(F.col("text")).alias("text"))
    return views.cell_starts(cells, ["conv_id"], ["turn"], "text").select("conv_id", "turn", "start")


@query("""
with p as (select conv_id, turn, ['C' || conv_id % 9, role, 't' || turn // 2] as path from conversations),
 q as (select *, lag(path) over (partition by conv_id order by turn) as b from p)
select conv_id, turn, case when b is null or path[1] <> b[1] then path[1] else '-' end || '|' || case when b is null or path[:2] <> b[:2] then path[2] else '-' end || '|' || case when b is null or path <> b then path[3] else '-' end as shown from q""")
def headings_that_differ(read):
    path = F.array(F.concat(F.lit("C"), F.col("conv_id") % 9), F.col("role"), F.concat(F.lit("t"), F.floor(F.col("turn") / 2)))
    shown = views.fresh_headings(read("conversations", "conv_id", "turn", "role").withColumn("path", path), "conv_id", "turn", "path")
    return shown.select("conv_id", "turn", F.array_join("shown", "|", "-").alias("shown"))


@query("select p_partkey, p_brand from part order by cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint), regexp_extract(p_brand, '[0-9]+(.*)$', 1), p_size nulls last, p_partkey limit 200")
def reading_order_first(read):
    return read("part").orderBy(*views.reading_order("p_brand", "p_size", "p_partkey")).limit(200).select("p_partkey", "p_brand")


@query("select distinct p_brand from part order by cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint), regexp_extract(p_brand, '[0-9]+(.*)$', 1), p_brand limit 12")
def viewer_parts_first(read):
    return read("part", "p_brand").distinct().orderBy(*views.viewer_order("p_brand")).limit(12)


@query("select o_orderkey, year(o_orderdate) as y from orders order by coalesce(try_cast(case when o_orderkey % 11 = 0 then 'n.d.' else cast(year(o_orderdate) as varchar) end as int), 0), o_orderpriority, o_orderkey limit 300")
def export_order_first(read):
    year = F.when(F.col("o_orderkey") % 11 == 0, "n.d.").otherwise(F.year("o_orderdate").cast("string"))
    rows = read("orders").withColumn("told", year).orderBy(*views.export_order("told", "o_orderpriority", "o_orderkey")).limit(300)
    return rows.select("o_orderkey", F.year("o_orderdate").cast("long").alias("y"))


@query("select kind, label from (select 'part' as kind, n_name as label from nation union all select 'provision', c_name from customer) order by case when kind = 'part' then 0 else 1 end, cast(regexp_extract(label, '([0-9]{1,15})', 1) as bigint), label limit 60")
def traversal_order_first(read):
    nodes = read("nation").select(F.lit("part").alias("kind"), F.col("n_name").alias("label")).unionByName(read("customer").select(F.lit("provision").alias("kind"), F.col("c_name").alias("label")))
    return nodes.orderBy(*views.traversal_order("kind", "label")).limit(60)


@query("select page_id from (select page_id, url from pages where regexp_extract(url, '://([^/]*)', 1) = (select min(regexp_extract(url, '://([^/]*)', 1)) from pages)) order by page_id limit 5")
def scoped_run(read):
    pages = read("pages", "page_id", "url").withColumn("part_id", T.url_parts(F.col("url"))["host"])
    return views.scoped(pages, pages.agg(F.min("part_id")).first()[0], 5, "part_id", [F.col("page_id")]).select("page_id")


@query("select l_orderkey, l_linenumber, o_custkey from lineitem join orders on l_orderkey = o_orderkey")
def required_join(read):
    return views.required(read("lineitem", "l_orderkey", "l_linenumber"), "l_orderkey", read("orders", "o_orderkey", "o_custkey"), "o_orderkey", "order")


@query("""
with fresh as (select doc_id, 'new' as status from labels where toxic = 1), prev as (select doc_id, 'old' as status from documents where n_chars < 2000),
 nav as (select doc_id from documents where lang in ('en', 'de')), checked as (select doc_id from labels where quality = 1)
select doc_id, status from fresh union all select doc_id, status from prev where doc_id in (select doc_id from nav) and doc_id not in (select doc_id from checked) and doc_id not in (select doc_id from fresh)""")
def unreachable_carried(read):
    docs, labels = read("documents", "doc_id", "lang", "n_chars"), read("labels")
    fresh = labels.where("toxic = 1").select("doc_id", F.lit("new").alias("status"))
    previous = docs.where("n_chars < 2000").select("doc_id", F.lit("old").alias("status"))
    return views.carried_unreachable(previous, fresh, docs.where("lang in ('en', 'de')"), labels.where("quality = 1"), "doc_id")


@query("""
select c_custkey, case when exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 200000) then 'held' when exists (select 1 from orders where o_custkey = c_custkey) then 'empty' else 'never' end as state from customer""")
def crawl_states(read):
    orders = read("orders", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return views.crawl_state(read("customer", "c_custkey"), orders, orders.where("o_totalprice > 200000"), "c_custkey")


@query("""
select l_orderkey, string_agg(l_linestatus || ':' || f || ':' || cast(l_suppkey as varchar), ' ' order by l_linestatus, f, cast(l_suppkey as varchar)) as edges
from (select *, case when l_returnflag <> 'N' then l_returnflag else '' end as f from lineitem) group by 1""")
def stable_arrays(read):
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    listed = views.stable_list(read("lineitem").select("l_orderkey", "l_linestatus", flag.alias("flag"), "l_suppkey"), "l_orderkey", ["l_linestatus", "flag", "l_suppkey"], "edges")
    return listed.select("l_orderkey", F.array_join(F.transform("edges", lambda e: F.concat_ws(":", e["l_linestatus"], e["flag"], e["l_suppkey"])), " ").alias("edges"))


@query("select conv_id, sha256(string_agg(text, chr(10) || chr(10) order by turn)) as page_hash from conversations group by 1")
def pages_reassembled(read):
    return views.reassembled(read("conversations"), "conv_id", "turn", "text").select("conv_id", F.sha2("text", 256).alias("page_hash"))


@query("select doc_id from documents where contains(lower(concat_ws(' ', cast(doc_id as varchar), source, text)), 'src1 ')")
def haystack_search(read):
    return read("documents").where(F.contains(views.haystack("doc_id", "source", "text"), F.lit("src1 "))).select("doc_id")


@query(f"""with {_GRAPH_SQL}, k as (select *, case when source < target then 'forward' else 'back' end as kind from g)
select source, target, concat_ws(',', case when kind <> 'forward' then 'kind' end, case when weight < 20 then 'weight' end,
  case when source not in (select n_name from nation where n_regionkey < 3) or target not in (select n_name from nation where n_regionkey < 3) then 'group' end) as hidden_by from k""")
def filters_to_relax(read):
    edges = _graph(read).withColumn("kind", F.when(F.col("source") < F.col("target"), "forward").otherwise("back"))
    return views.hidden_by(edges, ["forward"], 20, read("nation").where("n_regionkey < 3").select(F.col("n_name").alias("id"))).select("source", "target", "hidden_by")


@query(f"""with {_GRAPH_SQL}, n as (select target as id, 'out' as direction, weight from g where source = 'NATION_1' union all select source, 'in', weight from g where target = 'NATION_1')
select direction, r_name as label, count(*) as n, cast(sum(weight) as bigint) as weight, row_number() over (partition by direction order by count(*) desc, r_name) as place
from n join nation on id = n_name join region on n_regionkey = r_regionkey group by 1, 2""")
def neighbour_groups(read):
    groups = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("id"), F.col("r_name").alias("label"))
    return views.neighbour_groups(graph.neighbours(_graph(read).withColumn("kind", F.lit("trade")), "NATION_1"), groups)


@query("""
with b as (select c_nationkey as g, (min(c_acctbal) + max(c_acctbal)) / 2 as mx, (min(c_custkey) + max(c_custkey)) / 2 as my from customer group by 1)
select c_nationkey, arg_min(c_custkey, ((c_acctbal - mx) * (c_acctbal - mx) + (c_custkey - my) * (c_custkey - my), c_custkey)) as id from customer join b on c_nationkey = g group by 1""")
def nearest_to_centre(read):
    placed = read("customer").select("c_nationkey", F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), F.col("c_custkey").alias("y"))
    return views.nearest_to_centre(placed, "c_nationkey")


@query("""
with b as (select p_brand as part, min(p_type) as title, count(*) as n from part where p_size < 30 and p_brand <> 'Brand#12' group by 1),
 a as (select p_brand as part, min(p_type) as title, count(*) as n from part where p_size >= 20 and p_brand <> 'Brand#13' group by 1)
select coalesce(a.part, b.part) as part, case when b.part is null then 'added' when a.part is null then 'removed' when b.title = a.title and b.n = a.n then 'unchanged'
  else concat_ws(',', case when b.title <> a.title then 'renamed' end, case when b.n <> a.n then 'resized' end) end as status from b full join a on b.part = a.part""")
def part_changes(read):
    of = lambda test: read("part").where(test).groupBy(F.col("p_brand").alias("part")).agg(F.min("p_type").alias("title"), F.count(F.lit(1)).alias("n"))
    return views.part_diff(of("p_size < 30 and p_brand <> 'Brand#12'"), of("p_size >= 20 and p_brand <> 'Brand#13'"), "part")


@query(f"""with {_STATES_SQL} select coalesce(a.key, b.key) as key from b join a on a.key = b.key
where a.body is not distinct from b.body and a.lang is not distinct from b.lang and a.n_chars is not distinct from b.n_chars and a.source is distinct from b.source""")
def version_bumps(read):
    return views.bumped(changes.compared(*_states(read), "key", "body", ["lang", "source", "n_chars"]), "source").where("bump_only").select("key")


@query(f"with {_STATES_SQL} select a.key from b join a on a.key = b.key where a.body is distinct from b.body and a.n_chars is not distinct from b.n_chars")
def silent_amendments(read):
    return views.silent_amendments(*_states(read), "key", "body", "n_chars")


@query(f"with {_STATES_SQL} select a.key, b.source as was, a.source as now from b join a on a.key = b.key where a.source is distinct from b.source")
def readdressed_pages(read):
    return views.readdressed(*_states(read), "key", "source")


# Search and bundles over a corpus shaped from the tables.

def _corpus(read) -> SimpleNamespace:
    """Passages with edges, pages, provisions with units and the nav, as ``sources.snapshot.Corpus`` has them."""
    docs = read("documents").join(read("labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality")), "doc_id", "left")
    act = F.concat(F.lit("ACT"), F.col("doc_id") % 3, F.lit("/s"), F.col("doc_id") % 40)
    certainty = F.when(F.col("quality") == 1, "explicit").when(F.col("quality") == 0, "default")
    edge = F.struct(act.alias("id"), F.lit("regex").alias("extraction"), certainty.alias("certainty"), F.lit("s").alias("mention"))
    empty = F.array().cast("array<struct<id:string,extraction:string,certainty:string,mention:string>>")
    inner = F.struct(F.concat(F.lit("D/"), (F.col("doc_id") * 7) % 1003).alias("ref"))
    case = F.struct(F.concat(F.lit("case-"), F.col("doc_id") % 13).alias("id"), F.concat(F.lit("[2001] AB "), F.col("doc_id") % 13).alias("citation"))
    chunks = docs.select(
        F.concat(F.lit("D/"), "doc_id").alias("chunk_ref"), F.concat(F.lit("P/"), "source").alias("page_ref"), F.col("source").alias("part_id"), "text", F.col("lang").alias("kind"),
        F.when(F.col("toxic") == 1, "inferred").alias("heading_source"), F.array("lang", "source").alias("heading_path"), F.lit(None).cast("string").alias("fragment"),
        F.when(F.col("doc_id") % 2 == 0, F.array(edge)).otherwise(empty).alias("provisions"), F.array(inner).alias("internal_refs"), F.when(F.col("doc_id") % 5 == 0, F.array(case)).alias("cases"),
    )
    pages = read("documents", "source").distinct().select(F.concat(F.lit("P/"), "source").alias("page_ref"), F.col("source").alias("part_id"), F.concat(F.lit("20"), F.lpad(F.length("source"), 2, "0"), F.lit("-01-01")).alias("last_amended"))
    provisions = read("orders").where("o_orderkey < 120").select(F.concat(F.lit("ACT"), F.col("o_orderkey") % 3, F.lit("/s"), F.col("o_orderkey") % 40).alias("ref")).distinct()
    provisions = provisions.select("ref", F.substring_index("ref", "/", 1).alias("instrument"))
    edges = chunks.select("chunk_ref", "page_ref", "part_id", F.posexplode("provisions").alias("seq", "edge")).select("chunk_ref", "page_ref", "part_id", "seq", "edge.*")
    units = provisions.select(F.concat("ref", F.lit("(1)")).alias("ref"), F.col("ref").alias("provision"))
    nav = pages.select("page_ref", "part_id", F.upper("part_id").alias("part_title"))
    return SimpleNamespace(chunks=chunks, pages=pages, provisions=provisions, edges=edges, units=units, nav=nav)


_CORPUS_SQL = """l as (select doc_id, max(toxic) as toxic, max(quality) as quality from labels group by 1),
 c as (select d.doc_id, 'D/' || d.doc_id as chunk_ref, 'P/' || source as page_ref, source as part_id, text, lang as kind, lang || ' ' || source as path, toxic,
   case when d.doc_id % 2 = 0 then 'ACT' || d.doc_id % 3 || '/s' || d.doc_id % 40 end as id, case when quality = 1 then 'explicit' when quality = 0 then 'default' end as certainty,
   'D/' || (d.doc_id * 7) % 1003 as inner_ref, case when d.doc_id % 5 = 0 then 'case-' || d.doc_id % 13 end as case_id from documents d left join l on d.doc_id = l.doc_id),
 v as (select distinct 'ACT' || o_orderkey % 3 || '/s' || o_orderkey % 40 as ref from orders where o_orderkey < 120)"""


@query(f"with {_CORPUS_SQL} select chunk_ref from c where id like 'ACT1/%' and coalesce(certainty, 'none') in ('explicit', 'none') and contains(lower(chunk_ref || ' ' || path || ' ' || text), 'the') and kind in ('en', 'fr')")
def passage_search(read):
    q = search.Question(instruments=("ACT1",), certainty=("explicit", "none"), text="The", kinds=("en", "fr"))
    found = _corpus(read)
    return search.passages(q, found.chunks, found.pages).select("chunk_ref")


@query(f"with {_CORPUS_SQL} select chunk_ref from c where part_id in ('src0', 'src3') and contains(case_id, 'case-1') and coalesce(case when toxic = 1 then 'inferred' end, 'none') in ('none') and chunk_ref in (select inner_ref from c)")
def passage_search_cited(read):
    q = search.Question.from_params("parts=src0,src3&case=CASE-1&heading_source=none&cited=yes")
    found = _corpus(read)
    return search.passages(q, found.chunks, found.pages).select("chunk_ref")


@query("select part_id, n, array_to_string(refs[:5], ',') as refs from (select source as part_id, count(*) as n, list('D/' || doc_id order by 'D/' || doc_id) as refs from documents group by 1)")
def results_grouped(read):
    return search.grouped(_corpus(read).chunks, "part_id", "chunk_ref", 5).select("part_id", "n", F.array_join("refs", ",").alias("refs"))


@query(f"""with {_CORPUS_SQL}, f as (
  select 'instrument' as facet, split_part(id, '/', 1) as value from c where id is not null union all select 'provision', id from c where id is not null
  union all select 'extraction', 'regex' from c where id is not null union all select 'certainty', coalesce(certainty, 'none') from c where id is not null
  union all select 'kind', coalesce(kind, 'none') from c union all select 'heading_source', case when toxic = 1 then 'inferred' else 'none' end from c
  union all select 'year', '20' || lpad(cast(length(source) as varchar), 2, '0') from (select distinct source from documents) where source is not null
  union all select 'case', case_id from c where case_id is not null)
select facet, value, count(*) as n, row_number() over (partition by facet order by count(*) desc, value) as rank from f group by facet, value""")
def bundle_facets(read):
    return bundle.facets(_corpus(read))


@query("select source as part_id, upper(source) as title, 1 as pages, count(*) as chunks from documents group by source")
def bundle_parts(read):
    return bundle.parts(_corpus(read)).select("part_id", "title", F.col("pages").cast("int").alias("pages"), "chunks")


@query(f"with {_CORPUS_SQL} select inner_ref as target, string_agg(chunk_ref, ',' order by chunk_ref) as sources, count(*) as n from (select distinct inner_ref, chunk_ref from c where inner_ref <> chunk_ref) group by 1")
def bundle_cited_by(read):
    return bundle.cited_by(_corpus(read))


@query(f"with {_CORPUS_SQL}, e as (select id from c where id is not null and split_part(id, '/', 1) in (select split_part(ref, '/', 1) from v)) select count(*) as edges, count(*) filter (id in (select ref from v)) as resolved, count(distinct case when id not in (select ref from v) then id end) as unresolved_refs from e")
def bundle_cross_report(read):
    return bundle.cross_report(_corpus(read))


@query(f"with {_CORPUS_SQL} select count(*) as total, count(*) filter (split_part(id, '/', 1) in ('ACT0', 'ACT2')) as in_scope, count(*) filter (split_part(id, '/', 1) in ('ACT0', 'ACT2') and id in (select ref from v)) as resolved from c where id is not null")
def edge_coverage(read):
    found = _corpus(read)
    return validate.coverage(found.edges, found.provisions, ["ACT0", "ACT2"])


@query(f"""with {_CORPUS_SQL}, r as (select chunk_ref, inner_ref from c), e as (
  select chunk_ref as w, 'nothing has the address ' || inner_ref as m from r where inner_ref not in (select chunk_ref from c) and inner_ref not in (select page_ref from c where page_ref is not null))
select w as chunk_ref, m as message from e""")
def broken_references(read):
    found = _corpus(read)
    chunks = found.chunks.withColumn("headings", F.array().cast("array<struct<ref:string>>"))
    return validate.reference_failures(found.pages.where("page_ref is not null"), chunks, found.nav.where("page_ref is not null"))[0].select(F.col("where").alias("chunk_ref"), "message")
