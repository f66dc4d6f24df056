"""Registered queries and the SQL that checks them.

The crawled ``pages`` stand for corpus pages, their links for citations, ``documents`` and conversation
turns for passages, ``lineitem`` for reference edges, and the small tables for registers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import markup
from ..functions import text as T
from ..operators import changes, citing, graph, relations, views
from ..sources.publish import stage

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

LINK = r'<a href="([^"]*)">([^<]*)</a>'


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name, *cols: spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*(cols or ("*",))))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _links(read) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit(LINK), F.lit(1))
    words = F.regexp_extract_all("html", F.lit(LINK), F.lit(2))
    zipped = F.arrays_zip(found.alias("href"), words.alias("words"))
    return read("pages", "page_id", "url", "html").select("page_id", "url", F.posexplode(zipped).alias("pos", "link")).select("page_id", "url", F.col("pos").cast("long").alias("pos"), F.col("link.href").alias("href"), F.col("link.words").alias("words"))


LINKS_SQL = """links as (
  select page_id, url, generate_subscripts(h, 1) - 1 as pos, unnest(h) as href, unnest(w) as words
  from (select page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) h,
               regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) w from pages))"""
HOST_SQL = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
PATH_SQL = "regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1), '/+$', '')"


@query("select doc_id, 'sha256:' || sha256(text) as content_hash from documents")
def content_hash(read):
    return read("documents", "doc_id", "text").select("doc_id", T.digest(F.col("text")).alias("content_hash"))


@query(r"select doc_id, sha256(trim(regexp_replace(regexp_replace(text, '[\x{200b}\x{200c}\x{200d}\x{feff}]', '', 'g'), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]+', ' ', 'g'))) as norm_hash from documents")
def normalise_text_hash(read):
    return read("documents", "doc_id", "text").select("doc_id", F.sha2(T.normalised(F.col("text")), 256).alias("norm_hash"))


@query("select item_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') as slug from benchmark")
def slug_address(read):
    return read("benchmark").select("item_id", T.slug(F.col("text")).alias("slug"))


@query(f"with {LINKS_SQL} select page_id, cast(pos as bigint) as pos, href, words from links")
def page_links(read):
    return _links(read).select("page_id", "pos", "href", "words")


@query(f"select page_id, {HOST_SQL} as host, {PATH_SQL} as path, regexp_extract(url, '#(.*)$', 1) as fragment, case when {HOST_SQL} <> '' then lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) || '://' || {HOST_SQL} || {PATH_SQL} else {PATH_SQL} end as canonical from pages")
def url_inventory(read):
    part = T.url_parts(F.col("url"))
    return read("pages", "page_id", "url").select("page_id", part["host"].alias("host"), part["path"].alias("path"), part["fragment"].alias("fragment"), T.canonical_url(F.col("url")).alias("canonical"))


@query(f"select {HOST_SQL} as host, count(*) as page_count, arg_max(url, page_id) as last_url from pages group by 1")
def nav_inventory_counts(read):
    pages = read("pages", "page_id", "url").withColumn("host", T.url_parts(F.col("url"))["host"])
    return pages.groupBy("host").agg(F.count(F.lit(1)).alias("page_count"), F.max_by("url", "page_id").alias("last_url"))


@query(f"select page_id, host, row_number() over (partition by host order by path, page_id) as ordinal from (select page_id, {HOST_SQL} as host, {PATH_SQL} as path from pages)")
def nav_ordinals(read):
    part = T.url_parts(F.col("url"))
    pages = read("pages", "page_id", "url").select("page_id", part["host"].alias("host"), part["path"].alias("path"))
    return pages.select("page_id", "host", F.row_number().over(Window.partitionBy("host").orderBy("path", "page_id")).cast("long").alias("ordinal"))


@query("""
with f as (
  select 'lang' as facet, coalesce(lang, 'none') as value, count(*) as n from documents group by 2
  union all select 'source', coalesce(source, 'none'), count(*) from documents group by 2
  union all select 'toxic', coalesce(cast(toxic as varchar), 'none'), count(*) from labels group by 2
  union all select 'role', coalesce(role, 'none'), count(*) from conversations group by 2)
select facet, value, n, row_number() over (partition by facet order by n desc, value) as rank from f""")
def facet_rank(read):
    of = lambda table, *names: relations.facet_values(read(table, *names), {n: F.col(n) for n in names})
    values = of("documents", "lang", "source").unionByName(of("labels", "toxic")).unionByName(of("conversations", "role"))
    return relations.in_ranks(relations.counted(values))


@query("""
select facet, value, sum(n) as n from (
  select 'segment' as facet, c_mktsegment as value, count(*) as n from customer group by 2
  union all select 'segment', 'supplier', count(*) from supplier
  union all select 'nation', n_name, count(*) from customer join nation on c_nationkey = n_nationkey group by 2
  union all select 'nation', n_name, count(*) from supplier join nation on s_nationkey = n_nationkey group by 2) group by all""")
def merged_facet_counts(read):
    nation = read("nation", "n_nationkey", "n_name")
    c, s = read("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")), read("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    facets = [relations.facet_counts(read("customer"), F.lit("segment"), "c_mktsegment"), relations.facet_counts(read("supplier"), F.lit("segment"), F.lit("supplier")), relations.facet_counts(c, F.lit("nation"), "n_name"), relations.facet_counts(s, F.lit("nation"), "n_name")]
    return relations.merged_facets(*facets)


@query(f"""with {LINKS_SQL}
select href as target, string_agg(page_id, ',' order by page_id) as sources, count(*) as n
from (select distinct href, cast(page_id as varchar) as page_id from links) group by href""")
def reverse_citation_index(read):
    return relations.reverse_index(_links(read), "page_id", "href")


@query("""
select l_orderkey, l_suppkey, l_returnflag, cast(l_linenumber as bigint) as seq, l_partkey from (
  select *, row_number() over (partition by l_orderkey, l_suppkey order by case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end, l_linenumber, l_partkey) as r from lineitem) where r = 1""")
def edge_dedup_precedence(read):
    edges = read("lineitem", "l_orderkey", "l_suppkey", "l_returnflag", F.col("l_linenumber").cast("long").alias("seq"), "l_partkey")
    rank = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    return relations.strongest(edges, ["l_orderkey", "l_suppkey"], rank, ["seq", "l_partkey"])


_EDGES_SQL = """edges as (select l_orderkey, 'S' || (l_partkey % 400) as ref from lineitem),
 r as (select e.ref, case when s.s_suppkey is not null then e.ref when p.p_partkey is not null then p.p_brand end as owner
       from edges e left join supplier s on e.ref = 'S' || s.s_suppkey left join (select * from part where p_size <= 20) p on e.ref = 'S' || p.p_partkey)"""


def _two_step(read) -> DataFrame:
    edges = read("lineitem", "l_orderkey", F.concat(F.lit("S"), F.col("l_partkey") % 400).alias("ref"))
    firsts = read("supplier", F.concat(F.lit("S"), F.col("s_suppkey")).alias("ref"))
    seconds = read("part").where("p_size <= 20").select(F.concat(F.lit("S"), F.col("p_partkey")).alias("ref"), F.col("p_brand").alias("owner"))
    return relations.resolved(edges, "ref", firsts, seconds)


@query(f"with {_EDGES_SQL} select count(*) as edges, count(owner) as resolved, count(distinct case when owner is null then ref end) as unresolved_refs from r")
def resolve_two_step(read):
    return relations.join_report(_two_step(read), "ref")


@query(f"with {_EDGES_SQL} select 'ref' as facet, ref as value, count(*) as n, row_number() over (order by count(*) desc, ref) as rank from r where owner is null group by ref")
def unresolved_ranked(read):
    return relations.ranked(_two_step(read).where("owner is null"), F.lit("ref"), "ref")


@query(f"""
with p as (select page_id, {HOST_SQL} as host, {PATH_SQL} as path from pages),
 s as (select distinct host, path, array_to_string(list_slice(string_split(path, '/'), 1, n), '/') as prefix, n
       from p, range(1, 12) t(n) where n < len(string_split(path, '/'))),
 known as (select distinct host, path as prefix from p union select distinct host, '/en' from p),
 best as (select s.host, s.path, arg_max(s.prefix, s.n) as ancestor from s join known k on s.host = k.host and s.prefix = k.prefix group by all)
select page_id, p.host, p.path, ancestor from p left join best b on p.host = b.host and p.path = b.path""")
def longest_prefix_resolve(read):
    part = T.url_parts(F.col("url"))
    pages = read("pages", "page_id", "url").select("page_id", part["host"].alias("host"), part["path"].alias("path"))
    known = pages.select("host", "path").unionByName(pages.select("host", F.lit("/en").alias("path"))).distinct()
    return relations.nearest_ancestor(pages, "path", ["host"], known, "path").select("page_id", "host", "path", "ancestor")


@query("select o_orderkey, o_custkey from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0)")
def unresolved_refs(read):
    return relations.missing(read("orders", "o_orderkey", "o_custkey"), "o_custkey", read("customer").where("c_acctbal > 0"), "c_custkey")


_STATES_SQL = """b as (select doc_id as key, sha256(text) as body, lang, source, n_chars from documents),
 a as (select d.doc_id as key, case when l.quality = 0 then sha256(trim(text) || '.') else sha256(text) end as body, lang,
         case when l.toxic = 0 then 'moved' else source end as source, n_chars from documents d left join labels l on d.doc_id = l.doc_id where coalesce(l.toxic, 0) = 0
       union all select 1000000000 + item_id, sha256(text), null, null, length(text) from benchmark)"""


def _states(read) -> tuple[DataFrame, DataFrame]:
    docs, labels = read("documents"), read("labels")
    before = docs.select(F.col("doc_id").alias("key"), F.sha2("text", 256).alias("body"), "lang", "source", "n_chars")
    known = docs.join(labels, "doc_id", "left").where(F.coalesce("toxic", F.lit(0)) == 0)
    body = F.when(F.col("quality") == 0, F.sha2(F.concat(F.trim("text"), F.lit(".")), 256)).otherwise(F.sha2("text", 256))
    after = known.select(F.col("doc_id").alias("key"), body.alias("body"), "lang", F.when(F.col("toxic") == 0, "moved").otherwise(F.col("source")).alias("source"), "n_chars")
    items = read("benchmark").select((F.col("item_id") + 1_000_000_000).alias("key"), F.sha2("text", 256).alias("body"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"))
    return before, after.unionByName(items)


_DIFF_SQL = f"""{_STATES_SQL},
 d as (select coalesce(b.key, a.key) as key,
   case when b.key is null then 'added' when a.key is null then 'vanished' when b.body is distinct from a.body then 'amended'
        when b.lang is distinct from a.lang or b.n_chars is distinct from a.n_chars or b.source is distinct from a.source then 'reworded' else 'unchanged' end as status,
   concat_ws(',', case when b.lang is distinct from a.lang then 'lang' end, case when b.n_chars is distinct from a.n_chars then 'n_chars' end, case when b.source is distinct from a.source then 'source' end) as m
   from b full join a on b.key = a.key)"""


@query(f"with {_DIFF_SQL} select key, status, case when status in ('amended', 'reworded') then m else '' end as moved from d")
def snapshot_diff(read):
    return changes.compared(*_states(read), "key", "body", ["lang", "source", "n_chars"])


@query(f"with {_DIFF_SQL} select status, count(*) as n from d group by status")
def diff_headline(read):
    return changes.compared(*_states(read), "key", "body", ["lang", "source", "n_chars"]).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_DIFF_SQL}, w as (select doc_id as key from labels where toxic = 1)
select status2 as status, count(*) as n from (
  select case when status = 'vanished' and w.key is not null then 'retired' else status end as status2 from d left join w on d.key = w.key) group by 1""")
def diff_with_retirement(read):
    diff = changes.compared(*_states(read), "key", "body", ["lang", "source", "n_chars"])
    gone = read("labels").where("toxic = 1").select(F.col("doc_id").alias("key"))
    return changes.with_retirement(diff, gone.limit(0), gone, "key").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("""
with b as (select conv_id, turn, text from conversations where role <> 'system'),
 a as (select conv_id, turn, case when role = 'user' then upper(text) else text end as text from conversations where length(text) > 300)
select coalesce(b.conv_id, a.conv_id) as conv_id, count(*) filter (b.turn is not null and a.turn is not null and b.text is distinct from a.text) as edited,
  count(*) filter (b.turn is null) as added, count(*) filter (a.turn is null) as removed, count(*) filter (a.turn is not null) as total
from b full join a on b.conv_id = a.conv_id and b.turn = a.turn group by 1""")
def chunk_change_counts(read):
    turns = read("conversations")
    before = turns.where("role <> 'system'").select("conv_id", "turn", "text")
    after = turns.where("length(text) > 300").select("conv_id", "turn", F.when(F.col("role") == "user", F.upper("text")).otherwise(F.col("text")).alias("text"))
    return changes.part_changes(before, after, "conv_id", "turn", "text")


@query(f"""with {_STATES_SQL}
select case when b.key is null then 'new' when b.body is not distinct from a.body and b.lang is not distinct from a.lang and b.source is not distinct from a.source and b.n_chars is not distinct from a.n_chars then 'skip' else 'write' end as gate, count(*) as n
from a left join b on a.key = b.key group by 1""")
def skip_gate(read):
    before, after = _states(read)
    return changes.gated(before, after, "key", ["body", "lang", "source", "n_chars"]).groupBy("gate").agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_STATES_SQL}
select coalesce(a.key, b.key) as key, case when a.key is null then '2020' when a.body is not distinct from b.body and b.key is not null then '2020' else '2021' end as stamp from b full join a on a.key = b.key""")
def merge_carried_stamps(read):
    before, after = _states(read)
    return changes.merged(before.select("key", "body", F.lit("2020").alias("stamp")), after.select("key", "body", F.lit("").alias("stamp")), "key", ["body"], "stamp", "2021").select("key", "stamp")


@query("""
with live as (select distinct doc_id from labels where toxic = 0)
select doc_id as key, '2020' as retired_at from labels where toxic = 1 group by 1
union select doc_id, '2021' from documents d where doc_id not in (select doc_id from live) and doc_id not in (select doc_id from labels where toxic = 1)""")
def retire_prune(read):
    already = read("labels").where("toxic = 1").select(F.col("doc_id").alias("key"), F.lit("2020").alias("retired_at"))
    live = read("labels").where("toxic = 0").select(F.col("doc_id").alias("key"))
    return changes.retired(read("documents").select(F.col("doc_id").alias("key")), live, "key", already, "2021")


_BLOCKS_SQL = "blocks as (select doc_id, unnest(b) as block, generate_subscripts(b, 1) as pos from (select doc_id, string_split(text, chr(10)) as b from documents))"


def _blocks(read) -> DataFrame:
    return read("documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "block")).select("doc_id", (F.col("pos") + 1).cast("long").alias("pos"), "block")


@query(f"with {_BLOCKS_SQL} select doc_id, cast(pos as bigint) as pos, cast(coalesce(sum(length(block) + 1) over (partition by doc_id order by pos rows between unbounded preceding and 1 preceding), 0) as bigint) as start from blocks")
def block_starts(read):
    return relations.starts(_blocks(read), "doc_id", "pos", "block").select("doc_id", "pos", "start")


@query("select conv_id, turn, lag(role) over w as previous, lead(role) over w as following from conversations window w as (partition by conv_id order by turn)")
def prev_next(read):
    return relations.siblings(read("conversations", "conv_id", "turn", "role"), "conv_id", "turn", "role").select("conv_id", "turn", "previous", "following")


@query(f"""
with recursive {_BLOCKS_SQL}, p as (
  select doc_id, pos, cast(length(block) as bigint) as now, cast(1 as bigint) as groups, cast(length(block) as bigint) as largest from blocks where pos = 1
  union all
  select b.doc_id, b.pos, case when p.now > 0 and p.now + 1 + length(block) <= 2400 then p.now + 1 + length(block) else length(block) end,
    case when p.now > 0 and p.now + 1 + length(block) <= 2400 then p.groups else p.groups + 1 end,
    greatest(p.largest, case when p.now > 0 and p.now + 1 + length(block) <= 2400 then p.now + 1 + length(block) else length(block) end)
  from p join blocks b on b.doc_id = p.doc_id and b.pos = p.pos + 1)
select doc_id, arg_max(groups, pos) as groups, max(largest) as largest from p group by doc_id""")
def greedy_packing(read):
    folded = relations.packed(F.transform(F.split("text", "\n"), F.length), 2400)
    return read("documents", "doc_id", "text").select("doc_id", folded.alias("f")).select("doc_id", F.col("f.groups").alias("groups"), F.col("f.largest").alias("largest"))


@query("select conv_id, turn, last_value(case when role = 'user' then turn end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as heading from conversations")
def section_stack(read):
    heading = F.when(F.col("role") == "user", F.col("turn"))
    return relations.carried(read("conversations", "conv_id", "turn", "role"), "conv_id", "turn", heading, "heading").select("conv_id", "turn", "heading")


@query("""
select user_id, anchor, mark, value from (
  select a.user_id, a.event_id as anchor, m.event_id as mark, m.value, row_number() over (partition by a.user_id, a.event_id order by m.value desc, m.ts, m.event_id) as r
  from events a join events m on a.user_id = m.user_id and a.event_type = 'purchase' and m.event_type = 'click' and m.ts <= a.ts and m.ts >= a.ts - interval 6 hour) where r = 1""")
def adjacent_evidence(read):
    events = read("events", "event_id", "ts", "user_id", "event_type", "value")
    anchors = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("anchor"), F.col("ts").alias("at"))
    marks = events.where("event_type = 'click'").select("user_id", F.col("event_id").alias("mark"), "ts", "value")
    best = views.as_of(anchors, marks, "user_id", "at", "ts", 6 * 3600, [F.col("value").isNull().alias("a"), (-F.col("value")).alias("b"), F.col("ts").alias("c"), F.col("mark").alias("d")], ["mark", "value"])
    return best.select("user_id", "anchor", "mark", "value")


@query("select doc_id, item_id from documents d join benchmark b on instr(d.text, b.text) > 0")
def containment_join(read):
    return citing.contained(read("documents", "doc_id", "text"), read("benchmark", "item_id", F.col("text").alias("item")), "text", "item").select("doc_id", "item_id")


@query("select trim(regexp_replace(lower(left(text, 20)), '[^a-z0-9]+', '-', 'g'), '-') as label, count(*) as n from documents group by 1 having count(*) > 1")
def repeated_labels(read):
    return relations.duplicates(read("documents").select(T.slug(F.left("text", F.lit(20))).alias("label")), "label")


@query("select conv_id, turn, ordinal from (select conv_id, turn, row_number() over (partition by conv_id order by turn) - 1 as ordinal from conversations where role <> 'system') where turn <> ordinal")
def contiguous_ordinals(read):
    w = Window.partitionBy("conv_id").orderBy("turn")
    return read("conversations").where("role <> 'system'").select("conv_id", "turn", (F.row_number().over(w) - 1).cast("long").alias("ordinal")).where("turn <> ordinal")


@query("""
select doc_id from documents d where lang in ('en', 'fr') and source is not null and exists (select 1 from labels l where l.doc_id = d.doc_id and quality = 1)
  and exists (select 1 from labels l where l.doc_id = d.doc_id and toxic = 0) and contains(lower(text), 'the')""")
def faceted_search(read):
    labels = read("labels")
    docs = read("documents").where(F.col("lang").isin("en", "fr") & F.col("source").isNotNull())
    docs = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").join(labels.where("toxic = 0"), "doc_id", "left_semi")
    return docs.where(F.contains(F.lower("text"), F.lit("the"))).select("doc_id")


@query("""
select corpus, key, n from (
  select 'documents' as corpus, lang as key, count(*) as n from documents where contains(lower(text), 'en') group by lang
  union all select 'turns', role, count(*) from conversations where contains(lower(text), 'en') and role in ('user', 'assistant') group by role)""")
def two_corpus_search(read):
    needle = F.contains(F.lower("text"), F.lit("en"))
    a = read("documents").where(needle).groupBy(F.col("lang").alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("corpus", F.lit("documents"))
    b = read("conversations").where(needle & F.col("role").isin("user", "assistant")).groupBy(F.col("role").alias("key")).agg(F.count(F.lit(1)).alias("n")).withColumn("corpus", F.lit("turns"))
    return a.unionByName(b).select("corpus", "key", "n")


_GRAPH_SQL = """g as (select source, target, count(*) as weight from (
  select distinct cn.n_name as source, sn.n_name as target, l_orderkey, l_suppkey
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation cn on c_nationkey = cn.n_nationkey
  join supplier on l_suppkey = s_suppkey join nation sn on s_nationkey = sn.n_nationkey where cn.n_name <> sn.n_name) group by 1, 2)"""


#: Fixed value: pieces of the joins by order and by customer, so that a task's sort and distinct pairs stay small; a fixed number isn't put together again at run time, and up to 200 are written without a sort.
_PIECES = 200


def _graph(read) -> DataFrame:
    """Orders meet their customers first: joined and distinct by the order then, line items are shuffled once."""
    named = lambda key, name: read("nation", F.col("n_nationkey").alias(key), F.col("n_name").alias(name))
    orders = read("orders", "o_orderkey", "o_custkey").repartition(_PIECES, "o_custkey")
    source = orders.join(read("customer", F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").join(named("c_nationkey", "source"), "c_nationkey").select(F.col("o_orderkey").alias("l_orderkey"), "source")
    lines = read("lineitem", "l_orderkey", "l_suppkey").join(read("supplier", F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey").join(named("s_nationkey", "target"), "s_nationkey")
    edges = lines.select("l_orderkey", "l_suppkey", "target").repartition(_PIECES, "l_orderkey").join(source.repartition(_PIECES, "l_orderkey"), "l_orderkey")
    return graph.rolled_up(edges, "source", "target", "l_orderkey", "l_suppkey")


@query(f"with {_GRAPH_SQL} select * from g")
def graph_edges(read):
    return _graph(read)


@query(f"with {_GRAPH_SQL}, e as (select source as id, weight from g union all select target, weight from g) select id, cast(sum(weight) as bigint) as degree, count(*) as edge_count, max(weight) as heaviest from e group by id")
def graph_nodes_degree(read):
    return graph.nodes(_graph(read))


@query(f"""with {_GRAPH_SQL}, k as (select *, case when source < target then 'forward' else 'back' end as kind from g)
select source, target, weight, kind from k where (kind = 'back' or weight >= (select avg(weight) from g)) and source in (select n_name from nation where n_regionkey < 3) and target in (select n_name from nation where n_regionkey < 3)""")
def graph_visible(read):
    edges = stage(_graph(read)).withColumn("kind", F.when(F.col("source") < F.col("target"), "forward").otherwise("back"))
    least = edges.agg(F.avg("weight")).scalar()
    return graph.visible(edges, ["forward", "back"], least, ["forward"], read("nation").where("n_regionkey < 3").select(F.col("n_name").alias("id"))).select("source", "target", "weight", "kind")


@query(f"with {_GRAPH_SQL}, n as (select target as id, 'out' as direction, weight from g where source = 'NATION_1' union all select source, 'in', weight from g where target = 'NATION_1') select * from n")
def graph_neighbours(read):
    return graph.neighbours(_graph(read).withColumn("kind", F.lit("trade")), "NATION_1").select("id", "direction", "weight")


@query("""
select ancestor, count(*) as n, max(depth) as depth from (
  select 'R' || n_regionkey as ancestor, 1 as depth from nation union all select 'N' || c_nationkey, 1 from customer
  union all select 'R' || n_regionkey, 2 from customer join nation on c_nationkey = n_nationkey) group by 1""")
def hierarchy_rollup(read):
    a = read("nation").select(F.concat(F.lit("R"), "n_regionkey").alias("parent"), F.concat(F.lit("N"), "n_nationkey").alias("child"))
    b = read("customer").select(F.concat(F.lit("N"), "c_nationkey").alias("parent"), F.concat(F.lit("C"), "c_custkey").alias("child"))
    return relations.descendants(a.unionByName(b), "parent", "child", stage).groupBy("ancestor").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("depth"))


@query("""
select p_type, p_name, p_brand, rank, greatest(n - 3, 0) as more from (
  select p_type, p_name, p_brand, row_number() over (partition by p_type order by cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint), p_brand, p_partkey) as rank, count(*) over (partition by p_type) as n from part) where rank <= 3""")
def natural_order_topk(read):
    return relations.top_with_rest(read("part"), "p_type", [T.part_order(F.col("p_brand")), F.col("p_brand"), F.col("p_partkey")], 3).select("p_type", "p_name", "p_brand", "rank", "more")


@query(r"select doc_id, regexp_extract(text, '([A-Za-z0-9]+)@([a-z0-9.]+)', 1) as name, regexp_extract(text, '([A-Za-z0-9]+)@([a-z0-9.]+)', 2) as host, cast(len(regexp_extract_all(text, '[A-Za-z0-9]+@[a-z0-9.]+')) as bigint) as n from documents where regexp_matches(text, '[A-Za-z0-9]+@[a-z0-9.]+')")
def parse_reference_shapes(read):
    shape = "([A-Za-z0-9]+)@([a-z0-9.]+)"
    docs = read("documents", "doc_id", "text").where(F.col("text").rlike(shape))
    return docs.select("doc_id", F.regexp_extract("text", shape, 1).alias("name"), F.regexp_extract("text", shape, 2).alias("host"), F.size(F.regexp_extract_all("text", F.lit(shape), F.lit(0))).cast("long").alias("n"))


@query(r"select doc_id, unnest(regexp_extract_all(text, '([a-z]+), ([a-z]+)\.', 1)) as one, unnest(regexp_extract_all(text, '([a-z]+), ([a-z]+)\.', 2)) as other from documents")
def parallel_pairs(read):
    shape = F.lit(r"([a-z]+), ([a-z]+)\.")
    zipped = F.arrays_zip(F.regexp_extract_all("text", shape, F.lit(1)).alias("one"), F.regexp_extract_all("text", shape, F.lit(2)).alias("other"))
    return read("documents", "doc_id", "text").select("doc_id", F.inline(zipped))


@query("select doc_id, concat_ws('-', lang, source) as stem, replace(coalesce(lang, '') || '|' || coalesce(source, ''), '|', '\\|') as cell from documents")
def path_and_cell(read):
    return read("documents", "doc_id", "lang", "source").select("doc_id", T.file_stem(F.concat_ws("/", "lang", "source")).alias("stem"), T.escaped_cell(F.concat(F.coalesce("lang", F.lit("")), F.lit("|"), F.coalesce("source", F.lit("")))).alias("cell"))


@query("select lang, count(*) as files, sum(octet_length(encode(text))) as bytes, round(avg(length(text)), 2) as mean_chars, cast(max(length(text)) as bigint) as longest from documents group by lang")
def corpus_stats(read):
    return read("documents", "lang", "text").groupBy("lang").agg(F.count(F.lit(1)).alias("files"), F.sum(F.octet_length("text")).alias("bytes"), F.round(F.avg(F.length("text")), 2).alias("mean_chars"), F.max(F.length("text")).cast("long").alias("longest"))


@query(f"""with {LINKS_SQL}, t as (select page_id, href, count(*) over (partition by href) as corpus_count from links)
select page_id, href, corpus_count from t""")
def citation_counts(read):
    links = _links(read).select("page_id", "href")
    return links.join(links.groupBy("href").agg(F.count(F.lit(1)).alias("corpus_count")), "href").select("page_id", "href", "corpus_count")


@query()
def html_blocks_text(read):
    return markup.page_blocks(read("pages", "page_id", "html"))


@query("select 0 as bad from range(0) t(x)")
def html_spans_exact(read):
    return markup.broken_spans(read("pages", "page_id", "html")).select(F.lit(0).alias("bad"))


@query()
def html_chunks(read):
    return markup.page_chunks(read("pages", "page_id", "html"))


