"""Citations by link, in prose and by page number, on small fixtures."""

import pytest

from lexquarry.operators import inventory, provisions

LINK = "k int, href string, words string, seq int"


def edges(df):
    return {(r["k"], r["id"], r["certainty"] or r["extraction"]) for r in df.collect()}


def test_prose(spark):
    texts = [
        "Sections 24, 25 and 26(1)(a) or 27 apply; see subsection 41(3).", "section 41 of the Trade Marks Regulations 1995", "Trade Marks Regulations 1995 and section 5",
        "section 26 of the 1955 Act and the Acts Interpretation Act 1901; s 27", "s 217a, and reg. 21.11a", "section 4.7 and regulation 9", "paragraph 4.12(1)(b) of the Trade Marks Regulations 1995",
        "x" * 4090 + " s 9 of the 1905 Act", "section 3. In the 1955 Act", None, "", "section 8 of the Defence Act 1903, the 1955 Act", "section 7 of the\nTrade Marks Act 1995", "section 7 of the Trade\nMarks Act 1995",
    ]
    docs = spark.createDataFrame([*enumerate(texts), *enumerate(texts), (None, texts[3])], "k int, t string")  # all rows twice, and one without a key
    got = edges(provisions.cited_provisions(docs, spark.createDataFrame([], LINK), "k", "t"))
    assert {e for e in got if e[0] is None} == {(None, "TMA1955/s26", "explicit"), (None, "TMA1995/s27", "ambiguous")}
    assert {e for e in got if e[0] is not None} == {
        (0, "TMA1995/s24", "default"), (0, "TMA1995/s25", "default"), (0, "TMA1995/s26(1)(a)", "default"), (0, "TMA1995/s27", "default"), (0, "TMA1995/s41(3)", "default"),
        (1, "TMA1995/s41", "default"), (2, "TMA1995/s5", "default"), (3, "TMA1955/s26", "explicit"), (3, "TMA1995/s27", "ambiguous"), (4, "TMA1995/s217A", "default"), (4, "TMR1995/r21.11A", "default"),
        (6, "TMR1995/r4.12(1)(b)", "explicit"), (7, "TMA1905/s9", "explicit"), (8, "TMA1995/s3", "default"), (11, "TMA1955/s8", "explicit"), (12, "TMA1995/s7", "explicit"), (13, "TMA1995/s7", "default")}


def test_links(spark):
    path = "http://www.austlii.edu.au/au/legis/cth/consol_act/tma1995121/"
    rows = [(1, path + "s41.html", "sections 41(3) or 41(4)", 0), (1, path + "s41.html", "section 41", 1), (2, "/legis/cth/consol_reg/tmr1995264/s4.5.html", "it", 0), (2, "/legis/cth/consol_reg/tmr1995264/sch2.html", "it", 1), (3, "http://www.timebase.com.au/IPAust/index.cfm?id=tmact:217a", "", 0), (4, None, None, 0), (5, "/legis/cth/consol_act/abc2001/s1.html", None, 0)]
    links = spark.createDataFrame(rows, LINK)
    docs = spark.createDataFrame([(1, "section 41(3) of the Trade Marks Act 1995"), (9, "s 1")], "k int, t string")
    found = provisions.cited_provisions(docs, links, "k", "t")
    assert edges(found) == {(1, "TMA1995/s41(3)", "href"), (1, "TMA1995/s41(4)", "href"), (1, "TMA1995/s41", "href"), (2, "TMR1995/r4.5", "href"), (2, "TMR1995/sch2", "href"), (3, "TMA1995/s217A", "href"), (5, "ABC2001/s1", "href"), (9, "TMA1995/s1", "default")}
    bad = spark.createDataFrame([(1, "/legis/cth/consol_act/x/s1.html", "a", 0), (2, path + "notes3.html", "b", 0), (3, "timebase.com.au/IPAust/index.cfm?id=other:1", "c", 0)], LINK)
    assert {(r["k"], r["problem"]) for r in provisions.unreadable(bad, "k").collect()} == {(1, "unknown instrument"), (2, "unknown kind of page"), (3, "unknown instrument")}
    assert provisions.linked(bad, "k", strict=False).count() == 0
    with pytest.raises(Exception, match="unknown instrument"):
        provisions.linked(bad.where("k = 1"), "k").collect()


def test_pages_by_number(spark):
    pages = spark.createDataFrame([("M/Part22/15", "http://s/a"), ("M/Part2/3", "http://s/b"), ("M/Part32A/2/3", "http://s/c"), ("M/Part22", "http://s/d")], "page_ref string, url string")
    texts = [("M/Part1/1", "see part 22.15.7 and Parts 22.9"), ("M/Part32A/1", "part 2.3.1(c) of this chapter"), ("M/Part32A/1", "part  2.3.1"), ("M/Part2/3", "part 2.3.4"), (None, "part 2.3"), ("M/Part1/1", None), ("M/Part32A/1", "part 2.3. Of this chapter")]
    docs = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(texts)], "k int, page string, t string")
    got = {(r["k"], r["ref"], r["certainty"], r["mention"]) for r in provisions.numbered_pages(docs, pages, "k", "t", "page", "M").collect()}
    assert got == {
        (0, "M/Part22/15", "default", "part 22.15.7"), (1, "M/Part32A/2/3", "explicit", "part 2.3.1"), (2, "M/Part2/3", "ambiguous", "part 2.3.1"),
        (3, "M/Part2/3", "default", "part 2.3.4"), (4, "M/Part2/3", "default", "part 2.3"), (6, "M/Part2/3", "ambiguous", "part 2.3")}
    links = spark.createDataFrame([(0, "/a", "there", 0)], LINK)
    refs = provisions.internal_references(docs, links, pages, "k", "t", "page", "M", "http://s")
    assert {(r["ref"], r["extraction"]) for r in refs.where("k = 0").collect()} == {("M/Part22/15", "href")}


def test_decisions_and_anchors(spark):
    docs = spark.createDataFrame([(1, "[2018] FCAFC  109, (1954) 71 RPC 43; [2018] FCAFC 109"), (2, None)], "k int, t string")
    assert {(r["id"], r["citation"]) for r in provisions.decisions(docs, "k", "t").collect()} == {("CASE/2018/FCAFC/109", "[2018] FCAFC 109"), ("CASE/1954/RPC/71/43", "(1954) 71 RPC 43")}
    refs = spark.createDataFrame([("/p#4.5-goods-or-services",), ("/p#12A",), ("/p",)], "h string")
    from pyspark.sql import functions as F

    assert [r[0] for r in refs.select(inventory.anchor_ref(F.lit("M/P"), F.col("h"))).collect()] == ["M/P/4/5", "M/P/12A", "M/P"]


def test_prose_is_read_within_its_row(spark):
    """Before: four scans of the texts, windows over the matches and a join of the scope."""
    docs = spark.createDataFrame([(1, "section 5")], "k int, t string")
    plan = provisions.cited_provisions(docs, spark.createDataFrame([], LINK), "k", "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and plan.count("LogicalRDD") == 2  # texts and links
    # Many references and titles in one text: those that end a title are part of it, also beyond the first block of matches.
    text = "".join(f"section {i} of it, Trade Marks Regulations 1995. " for i in range(1, 701)) + "Trade Marks Regulations 1995(1)"
    got = provisions.in_prose(spark.createDataFrame([(1, text), (1, text)], "k int, t string"), "k", "t").collect()
    assert sorted((r["seq"]["at"], r["id"]) for r in got) == [(text.index(f"section {i} of"), f"TMA1995/s{i}") for i in range(1, 701)]


def test_page_numbers_are_read_once(spark):
    """Before: texts were read anew for the paths and for the rows."""
    pages = spark.createDataFrame([("M/Part2",)], "page_ref string")
    docs = spark.createDataFrame([(1, "M/Part1", "Part 2.3")], "k int, page string, t string")
    plan = provisions.numbered_pages(docs, pages, "k", "t", "page", "M")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "split(regexp_replace" not in plan


def test_spans_by_marks(spark):
    import re

    from pyspark.sql import functions as F

    from lexquarry.functions.spans import BLOCK, MARK, match_spans

    pattern = r"\bs[0-9]+"
    texts = ["", "none", "s1", "é😀 s1 xs2 s3", "s1" + MARK + "s2 " + MARK * 2 + "xs3 s4", *["s7 é. " * n for n in (2, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK)], (MARK + " s9") * (2 * BLOCK + 3)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "k int, t string").select("k", F.expr(match_spans("t", pattern)).alias("m"))
    assert "split(t" not in rows._jdf.queryExecution().optimizedPlan().toString()  # a cut by the pattern compiles it for every row
    assert {r["k"]: r["m"] if r["m"] is None else [tuple(x) for x in r["m"]] for r in rows.collect()} == {-1: None, **{i: [(*m.span(), m[0]) for m in re.finditer(pattern, t, re.A)] for i, t in enumerate(texts)}}
