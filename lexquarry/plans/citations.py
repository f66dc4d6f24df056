"""Registered queries of citations: texts and links are worded from columns of the tables, the SQL gives the ids from the columns themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import provisions
from .catalog import query

_N, _M = "(l_partkey % 300 + 1)", "(l_suppkey % 40 + 1)"


def _worded(read) -> DataFrame:
    """Line items as passages that cite provisions in five ways."""
    text = F.expr(f"""case l_linenumber % 5
        when 0 then concat('See sections ', {_N}, ' and ', {_M}, ' of the Trade Marks Act 1995 for this.')
        when 1 then concat('Under regulation ', {_M}, '.', {_N}, '(1) and section ', {_N}, '.')
        when 2 then concat('Section ', {_N}, ' of the 1955 Act, and section ', {_M}, '. Not about the Trade Marks Act 1995 alone')
        when 3 then concat('the text names section ', {_M}, '.', {_N}, ' only')
        else concat('paragraph ', {_M}, '.', {_N}, 'b of the  Trade Marks Regulations 1995') end""")
    return read("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("k"), text.alias("text"))


_WORDED_SQL = f"""w as (select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as k, l_linenumber % 5 as way, {_N} as n, {_M} as m from lineitem),
 e as (select k, 'TMA1995/s' || n as id, 'explicit' as certainty, 'sections ' || n || ' and ' || m || ' of the Trade Marks Act 1995' as mention from w where way = 0
  union select k, 'TMA1995/s' || m, 'explicit', 'sections ' || n || ' and ' || m || ' of the Trade Marks Act 1995' from w where way = 0
  union select k, 'TMR1995/r' || m || '.' || n || '(1)', 'default', 'regulation ' || m || '.' || n || '(1)' from w where way = 1
  union select k, 'TMA1995/s' || n, 'default', 'section ' || n from w where way = 1
  union select k, 'TMA1955/s' || n, 'explicit', 'Section ' || n || ' of the 1955 Act' from w where way = 2
  union select k, 'TMA1995/s' || m, 'ambiguous', 'section ' || m from w where way = 2
  union select k, 'TMR1995/r' || m || '.' || n || 'B', 'explicit', 'paragraph ' || m || '.' || n || 'b of the Trade Marks Regulations 1995' from w where way = 4)"""


@query(f"with {_WORDED_SQL} select k, id, certainty, mention from e")
def provisions_in_prose(read):
    links = read("orders").limit(0).select(F.col("o_orderkey").cast("string").alias("k"), F.lit("").alias("href"), F.lit("").alias("words"), F.lit(0).alias("seq"))
    return provisions.cited_provisions(_worded(read), links, "k", "text").select("k", "id", "certainty", "mention")


def _hrefs(read) -> DataFrame:
    n, m = "(o_custkey % 300 + 1)", "(o_custkey % 40 + 1)"
    href = f"""case when o_orderkey % 7 = 0 then 'http://example.org/' else case o_orderkey % 4
        when 0 then concat('http://www.austlii.edu.au/au/legis/cth/consol_act/tma1995121/s', {n}, 'a.html')
        when 1 then concat('http://www.austlii.edu.au/au/legis/cth/consol_reg/tmr1995230/sch', {m}, '.html')
        when 2 then concat('http://www.timebase.com.au/IPAust/index.cfm?id=tmreg:', {m}, '.', {n}, 'a')
        else concat('/au/legis/cth/consol_act/cca1995115/s', {m}, '.html') end end"""
    words = f"case o_orderkey % 4 when 0 then concat('section ', {n}, 'A(1) or ', {n}, 'a(2)(b)') when 1 then 'Schedule' else concat('section ', {n}) end"
    return read("orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("k"), F.expr(href).alias("href"), F.expr(words).alias("words"), F.lit(0).alias("seq"))


@query("""
with o as (select o_orderkey as k, o_orderkey % 4 as way, o_custkey % 300 + 1 as n, o_custkey % 40 + 1 as m from orders where o_orderkey % 7 <> 0)
select k, 'TMA1995/s' || n || 'A(1)' as id, 'section ' || n || 'A(1) or ' || n || 'a(2)(b)' as mention from o where way = 0
union select k, 'TMA1995/s' || n || 'A(2)(b)', 'section ' || n || 'A(1) or ' || n || 'a(2)(b)' from o where way = 0
union select k, 'TMR1995/sch' || m, 'Schedule' from o where way = 1
union select k, 'TMR1995/r' || m || '.' || n || 'A', 'section ' || n from o where way = 2
union select k, 'CCA1995/s' || m, 'section ' || n from o where way = 3""")
def provisions_by_link(read):
    return provisions.linked(_hrefs(read), "k").select("k", "id", "mention").distinct()


@query("""
with l as (select l_orderkey * 10 + l_linenumber as k, l_linenumber as own, l_suppkey % 9 + 1 as a, l_partkey % 7 as b, l_orderkey % 5 as c, l_partkey % 2 = 0 as here from lineitem),
 p as (select distinct 'M/Part' || p_size % 9 || '/' || p_partkey % 7 as ref from part where p_size < 30 union select distinct 'M/Part' || p_size % 9 || '/' || p_partkey % 7 || '/' || p_size % 5 from part where p_size > 20),
 r as (select k, here, case when 'M/Part' || a || '/' || b || '/' || c in (select ref from p) then 'M/Part' || a || '/' || b || '/' || c when 'M/Part' || a || '/' || b in (select ref from p) then 'M/Part' || a || '/' || b end as w,
   case when own <> a then case when 'M/Part' || own || '/' || a || '/' || b in (select ref from p) then 'M/Part' || own || '/' || a || '/' || b when 'M/Part' || own || '/' || a in (select ref from p) then 'M/Part' || own || '/' || a end end as i from l)
select k, case when i is not null and (here or w is null) then i else w end as ref, case when i is not null and here then 'explicit' when i is not null and w is not null then 'ambiguous' else 'default' end as certainty
from r where w is not null or i is not null""")
def pages_by_number(read):
    text = F.expr("concat('Before. See Part ', l_suppkey % 9 + 1, '.', l_partkey % 7, '.', l_orderkey % 5, if(l_partkey % 2 = 0, ' of this revised chapter', '. Of this chapter'))")
    docs = read("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.concat(F.lit("M/Part"), "l_linenumber", F.lit("/1")).alias("page_ref"), text.alias("text"))
    two = F.concat(F.lit("M/Part"), F.col("p_size") % 9, F.lit("/"), F.col("p_partkey") % 7)
    part = read("part", "p_partkey", "p_size")
    pages = part.where("p_size < 30").select(two.alias("page_ref")).unionByName(part.where("p_size > 20").select(F.concat(two, F.lit("/"), F.col("p_size") % 5).alias("page_ref")))
    return provisions.numbered_pages(docs, pages, "k", "text", "page_ref", "M").select("k", "ref", "certainty")


@query("select c_custkey as k, 'CASE/20' || lpad(cast(c_nationkey as varchar), 2, '0') || '/FCA/' || c_custkey % 999 as id from customer union select c_custkey, 'CASE/1954/RPC/' || (c_nationkey + 1) || '/' || c_custkey % 500 from customer")
def decisions_cited(read):
    text = F.expr("concat('see [20', lpad(c_nationkey, 2, '0'), ']  FCA ', c_custkey % 999, ', (1954) ', c_nationkey + 1, ' RPC ', c_custkey % 500, ' and [20', lpad(c_nationkey, 2, '0'), '] FCA ', c_custkey % 999)")
    return provisions.decisions(read("customer").select(F.col("c_custkey").alias("k"), text.alias("text")), "k", "text").select("k", "id")
