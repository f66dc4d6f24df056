"""Catalog queries against their SQL on the smallest tables, and operators on small fixtures."""

import glob
import io
import json
import os
import time
import zipfile

import duckdb
import pytest

from lexquarry.functions import markup
from lexquarry.functions import text as T
from lexquarry.operators import citing, layout, relations, search, views
from lexquarry.plans import catalog
from lexquarry.plans import runs as run_queries
from lexquarry.plans import citations as citation_queries
from lexquarry.plans import exports as export_queries
from lexquarry.plans import views as view_queries
from lexquarry.plans import structures as structure_queries
from lexquarry.sources.docx import document_blocks
from lexquarry.streaming import incremental

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def rows(values):
    tidy = lambda v: round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(map(tidy, r)) for r in values), key=str)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="tables aren't here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, oracle, name):
    df = catalog.QUERIES[name](spark, TABLES)
    columns = sorted(df.columns)
    got = rows(df.select(*columns).collect())
    if sql := catalog.ORACLE_SQL.get(name):
        assert got == rows(oracle.sql(f"select {', '.join(columns)} from ({sql}) q").fetchall())


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f("t").alias("x")).first()[0]


def test_text(spark):
    from pyspark.sql import functions as F

    assert one(spark, "\x1c a ​b　 c\n", lambda c: T.normalised(F.col(c))) == "a b c"
    assert one(spark, "  Hello, W-orld! ", lambda c: T.slug(F.col(c))) == "hello-w-orld"
    assert one(spark, "HTTPS://Ex.COM/a/b/?q=1#f", lambda c: T.canonical_url(F.col(c))) == "https://ex.com/a/b"
    refs = spark.createDataFrame([("G/Part2/10",), ("G/Part2/2",), ("G/Part10/1",), ("G/Part2/a",)], "r string")
    assert [r[0] for r in refs.orderBy(T.natural_key(F.col("r"))).collect()] == ["G/Part2/2", "G/Part2/10", "G/Part2/a", "G/Part10/1"]


HTML = """<body><nav><ul><li><a href=/a>A</a><ul><li><a href=/b>B</a></ul></ul></nav><main><h1>Title</h1><p>One <b>bold</b> and <a href="x">li nk</a>.</p>
<h2>1. First</h2><p>Text<p>More <img src=i.png><ul><li>a<ul><li>b</ul></ul><h2>Same</h2><p>x<h2>Same</h2><p>y<table><thead><tr><th colspan=2>H</th></tr></thead><tr><td>1<td rowspan=2>2</table></main>"""


def test_markup(spark):
    pages = spark.createDataFrame([(1, HTML), (2, None), (3, "")], "page_id long, html string")
    blocks = [(r["kind"], r["depth"], r["text"]) for r in markup.page_blocks(pages).where("page_id = 1").orderBy("pos").collect()]
    assert ("heading", 0, "Title") in blocks and ("list_item", 1, "a") in blocks and ("list_item", 2, "b") in blocks and ("image", 0, None) in blocks
    assert markup.broken_spans(pages).count() == 0
    spans = {(r["kind"], r["words"]) for r in markup.page_spans(pages).collect()}
    assert {("b", "bold"), ("link", "li nk")} <= spans
    refs = [r["chunk_ref"] for r in markup.page_chunks(pages).orderBy("ordinal").collect()]
    assert refs == ["P/1/title", "P/1/1", "P/1/#3", "P/1/#4"]
    table = markup.page_tables(pages).first()
    assert (table["header_row"], table["columns"]) == (0, 2)
    assert [(r["depth"], r["href"]) for r in markup.nav_entries(pages).orderBy("pos").collect()] == [(1, "/a"), (2, "/b")]
    assert markup.page_images(pages).collect()[0]["alt"] is None


def test_open_elements_cost_no_more_a_text():
    root, depth = markup.parsed("<b>x <i>\u200b" * 20_000 + " <a>\xa0</a>y\u200b"), 20_000
    start = time.process_time()
    text, spans = markup.flattened(root, frozenset({"a", "b", "i"}))
    assert time.process_time() - start < 5
    assert text == "x " * depth + "y" and sorted(a for n, a, _ in spans if n.tag == "b") == list(range(0, 2 * depth, 2)) and [x[1:] for x in spans if x[0].tag == "a"] == [(2 * depth, 2 * depth)]


def test_bold_headings_and_headings_without_text(spark):
    html = """<main><h1>Page</h1><h2>Empty</h2><h2>Over</h2><h3>Below</h3><p>a</p><h3>A</h3><p><b>3.1 First</b></p><p>b</p><p><span><em><strong>3.1.2(a): Deep</strong></em></span></p><p>c</p>
    <p><b>3.2</b> in prose</p><p><b>4.1 Another page's</b></p><p><b>3.15% of</b></p><div>loose <strong>3.3 Bare</strong></div><h2>Last one</h2></main>"""
    pages = spark.createDataFrame([(1, html, "G/Part1/3"), (2, html, "G/Part1/slug"), (3, html, None)], "page_id long, html string, page_ref string")
    got = {n: [(r["chunk_ref"], r["heading_path"][-1], r["heading_source"], r["text"]) for r in markup.page_chunks(pages).where(f"page_id = {n}").orderBy("ordinal").collect()] for n in (1, 2, 3)}
    at = "G/Part1/3"
    assert got[1] == [
        (f"{at}/empty", "Empty", "markup", "Empty"), (f"{at}/below", "Below", "markup", "a"), (f"{at}/3/1", "3.1 First", "emphasis", "b"),
        (f"{at}/3-1-2-a-deep", "3.1.2(a): Deep", "emphasis", "c 3.2 in prose 4.1 Another page's 3.15% of loose"), (f"{at}/3/3", "3.3 Bare", "emphasis", "3.3 Bare"), (f"{at}/last-one", "Last one", "markup", "Last one"),
    ]
    assert [x[1:3] for x in got[2]] == [("Empty", "markup"), ("Below", "markup"), ("A", "markup"), ("Last one", "markup")] and [x[0].replace("P/3", "G/Part1/slug") for x in got[3]] == [x[0] for x in got[2]]


def test_parsed_citations(spark):
    cases = spark.createDataFrame([("[1999] ABC 5",), ("(2001) 12 XYZ 33",), ("no case",)], "citation string")
    assert [(r["year"], r["series"], r["volume"], r["number"], r["known"]) for r in citing.parsed_citations(cases).collect()] == [("1999", "ABC", "", "5", True), ("2001", "XYZ", "12", "33", True), ("", "", "", "", False)]


def test_units_and_contents(spark):
    lines = [("ActHead2", "Part 1"), ("ActHead5", "41  Heading"), ("subsection", "(1) a"), ("paragraph", "(a) b"), ("notetext", "Note"), ("paragraph", "(a) c"), ("subsection", "plain"), ("ActHead5", "42  Other"), ("ENotesHeading1", "Endnote 1"), ("p", "words")]
    paragraphs = spark.createDataFrame([("I", i, s, t) for i, (s, t) in enumerate(lines)], "instrument string, pos int, style string, text string")
    assert [(r["ordinal"], r["number"], r["title"], r["containers"]) for r in layout.contents(paragraphs).orderBy("ordinal").collect()] == [(1, "41", "Heading", ["Part 1"]), (2, "42", "Other", ["Part 1"])]
    assert layout.endnotes(paragraphs).first().asDict() == {"instrument": "I", "number": 1, "title": "Endnote 1", "paragraphs": ["words"]}


def test_docx(spark):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="ActHead5"/></w:pPr><w:r><w:rPr><w:b/></w:rPr><w:t>41</w:t><w:tab/></w:r><w:r><w:rPr><w:b w:val="0"/></w:rPr><w:t>x</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:tcPr><w:gridSpan w:val="2"/><w:vMerge/></w:tcPr><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        archive.writestr("word/document.xml", body)
    found = document_blocks(spark.createDataFrame([("a", bytearray(data.getvalue())), ("b", bytearray(b"zip"))], "path string, content binary")).orderBy("path", "pos").collect()
    assert (found[0]["style"], found[0]["text"], [s.asDict() for s in found[0]["spans"]]) == ("ActHead5", "41\tx", [{"start": 0, "stop": 3, "weight": "bold"}])
    assert (found[1]["grid"][0][0]["colspan"], found[1]["grid"][0][0]["continues"]) == (2, True) and found[2]["problem"]


def test_as_of_and_prefixes(spark):
    refs = spark.createDataFrame([("h", "/a/b/c"), ("h", "/x/y"), ("h", "")], "g string, p string")
    known = spark.createDataFrame([("h", "/a"), ("h", "/a/b"), ("k", "/x")], "g string, q string")
    assert {r["p"]: r["ancestor"] for r in relations.nearest_ancestor(refs, "p", ["g"], known, "q").collect()} == {"/a/b/c": "/a/b", "/x/y": None, "": None}


def test_stream_merges_and_is_idempotent(spark, tmp_path):
    landed, seen = tmp_path / "landed", []
    landed.mkdir()
    run = lambda: incremental.follow(spark, str(landed), str(tmp_path / "state"), str(tmp_path / "cp"), lambda n: f"t{n}", lambda df: seen.append(sorted(r["url"] for r in df.collect()))).awaitTermination()
    (landed / "1.json").write_text("\n".join(json.dumps(x) for x in ({"url": "a", "status": 200, "html": "x"}, {"url": "b", "status": 200, "html": "y"}, {"url": "c", "status": 500})))
    run()
    (landed / "2.json").write_text("\n".join(json.dumps(x) for x in ({"url": "a", "status": 200, "html": "x"}, {"url": "b", "status": 200, "html": "z"}, {"url": "c", "status": 304})))
    run()
    assert seen == [["a", "b"], ["b"]]
    assert {r["url"]: (r["html"], r["first_seen"]) for r in incremental.state(spark, str(tmp_path / "state"), 99).collect()} == {"a": ("x", "t0"), "b": ("z", "t1")}


def test_view_queries_are_registered():
    assert {"spans_in_blocks", "passage_search", "bundle_facets", "provisions_in_prose", "resettled_refs"} <= set(catalog.QUERIES)
    assert view_queries.passage_search and citation_queries.pages_by_number and run_queries.resettled_refs and structure_queries.unit_addresses and export_queries.citation_export


def test_scope_and_required_raise(spark):
    pages = spark.createDataFrame([("p1", 2, "b"), ("p1", 1, "a"), ("p2", 1, "c")], "part string, ordinal int, ref string")
    assert [r["ref"] for r in views.scoped(pages, "p1", 1, "part", views.reading_order("part", "ordinal", "ref")).collect()] == ["a"]
    with pytest.raises(ValueError, match="p9"):
        views.scoped(pages, "p9", None, "part", [])
    with pytest.raises(Exception, match="no page c"):
        views.required(pages, "ref", pages.where("ref <> 'c'").select(pages["ref"].alias("known")), "known", "page").collect()


def test_as_of_takes_the_tolerance_and_ties(spark):
    anchors = spark.createDataFrame([("u", 1, "2020-01-01 06:00:00"), ("u", 2, "2020-01-01 00:00:01")], "g string, anchor int, at string").selectExpr("g", "anchor", "cast(at as timestamp_ntz) as at")
    marks = spark.createDataFrame([("u", 7, "2020-01-01 00:00:00"), ("u", 8, "2020-01-01 06:00:01"), ("v", 9, "2020-01-01 05:00:00"), ("u", 6, "2020-01-01 00:00:00")], "g string, mark int, ts string").selectExpr("g", "mark", "cast(ts as timestamp_ntz) as ts")
    best = views.as_of(anchors, marks, "g", "at", "ts", 6 * 3600, [marks["mark"]], ["mark"])
    assert {(r["anchor"], r["mark"]) for r in best.collect()} == {(1, 6), (2, 6)}


def test_first_unit_wins_in_search(spark):
    from types import SimpleNamespace

    edge = "array<struct<id:string,extraction:string,certainty:string,mention:string>>"
    provisions = spark.createDataFrame([("A/s1", [([("A/s2", "regex", None, "first")],), ([("A/s2", "regex", None, "second"), ("A/s3", "regex", "default", "x")],)])], f"ref string, units array<struct<provisions:{edge}>>")
    corpus = SimpleNamespace(provisions=provisions, units=SimpleNamespace(schema={"provisions": SimpleNamespace(dataType=edge)}))
    assert [(e["id"], e["mention"]) for e in search.with_edges(corpus).first()["provisions"]] == [("A/s2", "first"), ("A/s3", "x")]


def test_highlights_of_special_characters(spark):
    docs = spark.createDataFrame([(1, "a.b A.B axb (c) " + "a.b" * 600), (2, None)], "doc_id long, text string")
    found = views.highlights(docs, "doc_id", "text", "A.b").orderBy("start").collect()
    assert [(r["start"], r["stop"]) for r in found[:3]] == [(0, 3), (4, 7), (16, 19)] and len(found) == 602 and found[-1]["stop"] == 16 + 1800


def test_newest_answer_by_http_date(spark):
    rows = [("u", 200, "old", None, "Wed, 30 Dec 2020 10:00:00 GMT"), ("u", 200, "new", None, "Fri, 01 Jan 2021 10:00:00 GMT"), ("u", 200, "none", None, None)]
    fetched = spark.createDataFrame(rows, "url string, status int, html string, etag string, last_modified string")
    assert [r["html"] for r in incremental.usable(fetched).collect()] == ["new"]


def test_graph_joins_are_cut_in_pieces(spark):
    """Before: adaptive plans put the pieces of the joins together, so a task's sort and distinct pairs grew with the input; and the graph was worked out twice."""
    plan = catalog.QUERIES["graph_edges"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [l_orderkey") == 2 and f", {catalog._PIECES}" in plan
    assert "l_orderkey" not in catalog.QUERIES["graph_visible"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
