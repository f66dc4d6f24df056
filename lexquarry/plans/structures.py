"""Registered queries of units, hierarchies and spans, whose SQL is a recursive CTE: each result depends on those before it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relations, schema, units, views
from ..sources.publish import stage
from .catalog import query

_STYLE = "case when role = 'user' then 'subsection' when role = 'assistant' then 'paragraph' else 'notetext' end"
_LABEL = "case when role = 'user' then '(' || cast(turn % 5 as {s}) || ')' when turn % 3 > 0 then '(' || case when turn % 2 = 0 then 'a' else 'b' end || ')' end"


@query(f"""
with recursive t as (
  select cast(conv_id as varchar) as k, cast(row_number() over (partition by conv_id order by turn, {_STYLE}, coalesce(text, '')) as int) as ordinal, {_STYLE} as style,
    case when {_STYLE} <> 'notetext' then {_LABEL.format(s="varchar")} end as label, turn from conversations),
 p as (select *, case when style = 'subsection' then 0 when style = 'paragraph' then 1
     else coalesce(max(case when style = 'subsection' then 1000000 * ordinal + 1 when style = 'paragraph' then 1000000 * ordinal + 2 end) over w % 1000000, 0) end as depth,
     case when style = 'notetext' then max(case when style <> 'notetext' then ordinal end) over w end as host from t window w as (partition by k order by ordinal)),
 q as (select *, case when style = 'notetext' then host when style = 'paragraph' then (select max(b.ordinal) from p b where b.k = p.k and b.ordinal < p.ordinal and b.depth = 0) end as parent from p),
 bare as (select k, ordinal, coalesce(parent, 0) as above from q where label is null),
 kids as (select distinct q.k, q.parent, q.label from q where label is not null and parent is not null),
 clash as (select distinct k, above from (select b.k, b.above, kids.label from bare b join kids on kids.k = b.k and kids.parent = b.ordinal group by all having count(*) > 1)),
 s as (select q.*, q.label is null and c.k is null as clear from q left join bare b on b.k = q.k and b.ordinal = q.ordinal left join clash c on c.k = b.k and c.above = b.above),
 r as (
  select k, 0 as ordinal, cast([] as varchar[]) as claimed, map([0], ['C/' || k]) as refs, map([0], ['C/' || k]) as spaces, '' as ref, '' as wanted, false as again from (select distinct k from s)
  union all
  select k, ordinal, list_append(claimed, ref), map_concat(refs, map([ordinal], [ref])), map_concat(spaces, map([ordinal], [case when clear then space else ref end])), ref, wanted, again from (
   select *, case when label is null then above || '~' || list_filter(range(1, ordinal + 2), lambda n: not list_contains(claimed, above || '~' || n))[1]
      when again then wanted || '~' || list_filter(range(2, ordinal + 3), lambda n: not list_contains(claimed, wanted || '~' || n))[1] else wanted end as ref from (
    select *, space || label as wanted, label is not null and list_contains(claimed, space || label) as again from (
     select r.k, s.ordinal, s.label, s.clear, r.claimed, r.refs, r.spaces, r.refs[coalesce(s.parent, 0)] as above, r.spaces[coalesce(s.parent, 0)] as space from r join s on s.k = r.k and s.ordinal = r.ordinal + 1)))),
 g as (select distinct k, wanted from r where again)
select 'C/' || s.k as provision_ref, r.ref, case when s.parent is not null then up.ref end as parent_ref, s.ordinal, s.depth, s.label as number, g.k is not null as number_collision
from s join r on r.k = s.k and r.ordinal = s.ordinal left join r up on up.k = s.k and up.ordinal = s.parent left join g on g.k = s.k and g.wanted = r.wanted""")
def unit_addresses(read):
    """Turns as the units of their conversation: those of users under a few labels that come again, answers with a label or none, others as notes."""
    label = _LABEL.format(s="string")
    rows = read("conversations").select(F.expr("'C/' || conv_id").alias("provision_ref"), F.col("turn").alias("pos"), F.expr(_STYLE).alias("style"), F.expr(f"coalesce({label} || '\t', '') || coalesce(text, '')").alias("text"))
    return units.units(rows).select("provision_ref", "ref", "parent_ref", "ordinal", "depth", "number", "number_collision")


@query("""
with recursive e as (select c_custkey // 2 as p, c_custkey as c from customer where c_custkey > 1),
 r as (select p as a, c as n, 1 as depth from e union all select r.a, e.c, depth + 1 from r join e on e.p = r.n),
 i as (select o_custkey as node, o_orderdate::date as item from orders),
 u as (select node as a, item from i union all select r.a, i.item from i join r on r.n = i.node),
 n as (select a, count(distinct item) as n_items from u group by 1)
select coalesce(d.a, n.a) as ancestor, d.n_below, d.depth, n.n_items from (select a, count(*) as n_below, max(depth) as depth from r group by 1) d full join n on n.a = d.a""")
def deep_hierarchy(read):
    """Customers as a tree as deep as its size allows, with the distinct days of orders at and below each."""
    edges = read("customer", F.expr("c_custkey div 2").alias("p"), F.col("c_custkey").alias("c")).where("c > 1")
    pairs = relations.descendants(edges, "p", "c", stage)
    below = pairs.groupBy("ancestor").agg(F.count(F.lit(1)).alias("n_below"), F.max("depth").alias("depth"))
    items = relations.counted_above(pairs, read("orders", "o_custkey", F.to_date("o_orderdate").alias("day")), "o_custkey", "day")
    return below.join(items.withColumnRenamed("n", "n_items"), "ancestor", "full_outer")


@query("""
with recursive s as (select l_orderkey as k, l_linenumber as i, cast(l_partkey % 40 as bigint) as start, cast(l_partkey % 40 + l_suppkey % 13 as bigint) as stop from lineitem),
 o as (select *, row_number() over (partition by k order by start, i, stop) as n from s where stop > start),
 r as (select k, n, i, start, stop, true as kept, stop as at from o where n = 1
  union all select o.k, o.n, o.i, o.start, o.stop, o.start >= r.at, case when o.start >= r.at then o.stop else r.at end from r join o on o.k = r.k and o.n = r.n + 1)
select k, i, start, stop from r where kept""")
def spans_laid_down(read):
    start = F.col("l_partkey") % 40
    spans = read("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("i"), start.alias("start"), (start + F.col("l_suppkey") % 13).alias("stop"))
    return views.first_wins(spans, ["k"], "start", "stop", ["i"])


ORDER = {
    "type": "object", "required": ["key", "status", "day", "items"], "additionalProperties": False,
    "properties": {
        "key": {"type": "integer", "minimum": 1}, "status": {"type": "string", "enum": ["F", "O"]}, "day": {"type": "string", "format": "date"},
        "items": {"type": "array", "uniqueItems": True, "items": {"type": "object", "required": ["n"], "properties": {"n": {"type": ["integer", "null"], "minimum": 1}}}},
    },
}


@query("""
with t as (select *, o_orderkey as k from orders), g as (select * from t where k % 19 <> 0 and k % 23 <> 0)
select k, '' as path, 'json' as rule from t where k % 19 = 0 or k % 23 = 0
union all select k, '/key', 'minimum 1' from g where k < 1
union all select k, '/status', 'enum' from g where o_orderstatus not in ('F', 'O') or k % 11 = 0
union all select k, '/status', 'type string' from g where k % 11 = 0
union all select k, '/day', 'format date' from g where k % 13 = 0
union all select k, '/items', 'required' from g where k % 7 = 0
union all select k, '/items', 'uniqueItems' from g where k % 7 <> 0 and o_custkey % 5 = o_custkey % 3
union all select k, '/items/0/n', 'minimum 1' from g where k % 7 <> 0 and o_custkey % 5 = 0
union all select k, '/items/1/n', 'minimum 1' from g where k % 7 <> 0 and o_custkey % 3 = 0
union all select k, '/items/2/n', 'required' from g where k % 7 <> 0 and o_custkey % 4 = 0
union all select k, '/items/2', 'type object' from g where k % 7 <> 0 and o_custkey % 4 = 1
union all select k, '/note', 'additionalProperties' from g where k % 17 = 0""")
def schema_violations(read):
    """Orders as documents, many of them broken in some place."""
    text = F.expr("""concat('{"key":', o_orderkey, ',"status":', if(o_orderkey % 11 = 0, 'null', concat('"', o_orderstatus, '"')), ',"day":"', if(o_orderkey % 13 = 0, '2023-02-30', date_format(o_orderdate, 'yyyy-MM-dd')), '"',
      if(o_orderkey % 17 = 0, ',"note":1', ''), if(o_orderkey % 7 = 0, '', concat(',"items":[{"n":', o_custkey % 5, '},{"n":', o_custkey % 3, '},', case o_custkey % 4 when 0 then '{}' when 1 then '9' else '{"n":null}' end, ']')), '}')""")
    broken = F.when(F.col("o_orderkey") % 23 == 0, F.substring(text, 1, 9)).when(F.col("o_orderkey") % 19 != 0, text)
    return schema.violations(read("orders").select(F.col("o_orderkey").alias("k"), broken.alias("text")), "k", "text", ORDER)


@query("""
with recursive c as (select o_custkey as k, cast(dense_rank() over (partition by o_custkey order by o_orderkey) - 1 as int) as row, cast(row_number() over (partition by o_custkey, o_orderkey order by l_linenumber, l_partkey, l_suppkey) - 1 as int) as seat,
    cast(1 + l_suppkey % 3 as int) as colspan, cast(1 + l_partkey % 3 as int) as rowspan from lineitem join orders on l_orderkey = o_orderkey),
 n as (select *, row_number() over (partition by k order by row, seat) as n from c),
 r as (
  select k, cast(0 as bigint) as n, -1 as row, 0 as seat, 0 as at, cast([] as integer[]) as busy, 0 as col from (select distinct k from n)
  union all
  select k, n, row, seat, col + colspan, list_transform(range(0, greatest(len(busy), col + colspan)), lambda x: cast(case when x between col and col + colspan - 1 then greatest(row + rowspan, coalesce(busy[x + 1], 0)) else coalesce(busy[x + 1], 0) end as integer)), col from (
   select *, cast(list_filter(range(start, greatest(start, len(busy)) + 1), lambda x: coalesce(busy[x + 1], 0) <= row)[1] as int) as col from (
    select n.k, n.n, n.row, n.seat, n.colspan, n.rowspan, r.busy, case when n.row = r.row then r.at else 0 end as start from r join n on n.k = r.k and n.n = r.n + 1)))
select k, row, seat, col from r where n > 0""")
def table_occupancy(read):
    """A customer's orders as the rows of a table, their lines as cells of one to three columns and rows."""
    lines = read("lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("x"))
    cell = lambda x: F.struct(F.lit("").alias("text"), (1 + x["l_suppkey"] % 3).cast("int").alias("colspan"), (1 + x["l_partkey"] % 3).cast("int").alias("rowspan"))
    rows = lines.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list("x")), cell).alias("cells"))
    own = read("orders", "o_orderkey", F.col("o_custkey").alias("k")).join(rows, F.col("o_orderkey") == F.col("l_orderkey"))
    tables = own.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "cells"))), lambda x: x["cells"]).alias("cells"))
    return tables.select("k", F.inline(views.occupied("cells"))).select("k", "row", "seat", F.col("column").alias("col"))
