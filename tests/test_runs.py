"""Runs over an existing snapshot, writers read back, and rules on units, on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import report, settling, structure
from lexquarry.sources import documents
from lexquarry.sources.snapshot import canonical_json, read_corpus
from tests.test_corpus import chunk, edge, page


def held(root, files):
    for name, value in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(value))
    return str(root)


def nav(*rows):
    return {"parts": [], "pages": [{"url": u, "page_ref": r, "part_id": p, "part_title": t, "nav_title": r, "kind": "body", "nav_ordinal": 1} for u, r, p, t in rows]}


def test_compared_corpora(spark, tmp_path):
    one, two = chunk("G/Part1/1/1", "G/Part1/1", 1, "One"), chunk("G/Part1/1/1", "G/Part1/1", 1, "Other")
    before = held(tmp_path / "b", {
        "pages/a.json": page("G/Part1/1", "Part1", [one]), "pages/b.json": page("G/Part1/2", "Part1", [], content_hash="x"), "pages/c.json": page("G/Part2/1", "Part2", []), "pages/d.json": page("G/Part2/2", "Part2", []),
        "pages/e.json": page("G/Part2/3", "Part2", [], nav_title="Old"), "pages/_retired/f.json": page("G/Part2/4", "Part2", []), "sitemap.json": nav(("u1", "G/Part1/1", "Part1", "One"), ("u2", "G/Part2/1", "Part2", "Two"), ("u3", "G/Part3/1", "Part3", "Three")),
    })
    after = held(tmp_path / "a", {
        "pages/a.json": page("G/Part1/1", "Part1", [two]), "pages/b.json": page("G/Part1/2", "Part1", [], content_hash="y"), "pages/_retired/c.json": page("G/Part2/1", "Part2", []),
        "pages/e.json": page("G/Part2/3", "Part2", [], nav_title="New"), "pages/f.json": page("G/Part2/4", "Part2", []), "pages/g.json": page("G/Part2/5", "Part2", []),
        "sitemap.json": nav(("u1", "G/Part1/9", "Part1", "One"), ("u2", "G/Part2/1", "Part2", "Second"), ("u4", "G/Part2/5", "Part2", "Second")),
    })
    got = settling.compared_corpora(read_corpus(spark, before), read_corpus(spark, after))
    assert {r["page_ref"]: (r["status"], r["moved"]) for r in got["pages"].collect()} == {
        "G/Part1/1": ("amended", ""), "G/Part1/2": ("amended", ""), "G/Part2/1": ("retired", ""), "G/Part2/2": ("vanished", ""), "G/Part2/3": ("reworded", "nav_title"), "G/Part2/4": ("restored", ""), "G/Part2/5": ("added", ""),
    }
    assert dict(map(tuple, got["parts"].collect())) == {"Part1": "unchanged", "Part2": "renamed,resized", "Part3": "removed"}
    assert [tuple(r) for r in got["readdressed"].collect()] == [("u1", "G/Part1/1", "G/Part1/9")]
    assert [r[0] for r in got["silent"].collect()] == ["G/Part1/2"]  # its body moved, its log didn't; a chunk alone isn't the body
    text = report.corpus_report(read_corpus(spark, before), read_corpus(spark, after), ("one", "two"), spark.createDataFrame([("http://s/x", 500)], "url string, status int"))
    assert "2 pages amended, 1 page added, 1 page restored, 1 page retired, 1 page vanished, 1 page reworded; 0 pages unchanged." in text
    assert "| G/Part1/1 | 1 | 0 | 0 | 1 | - |" in text and "| G/Part1/2 | 0 | 0 | 0 | 0 | - |" in text
    sections = {part.split("\n")[0]: part for part in text.split("## ")[1:]}
    assert "- Part2: renamed,resized\n- Part3: removed" in sections["Parts (2)"] and "- u1: G/Part1/1 → G/Part1/9" in sections["Addresses that tell another page (1)"]
    assert "- G/Part1/2\n" in sections["Amended without a word in the log (1)"] and "- G/Part2/3: nav_title" in sections["Changed around the text (1)"] and "- http://s/x: 500" in sections["Unreachable (1)"]
    short = report.corpus_report(read_corpus(spark, before), read_corpus(spark, after), cap=1)
    assert "## Amended (2)" in short and "… and 1 more" in short and "G/Part1/2 | 0" not in short
    assert "Nothing changed; " in report.corpus_report(read_corpus(spark, before), read_corpus(spark, before))
    first = report.corpus_report(read_corpus(spark, str(tmp_path / "none")), read_corpus(spark, after))
    assert "5 pages in 2 parts; nothing to compare with." in first
    none = settling.compared_corpora(read_corpus(spark, str(tmp_path / "none")), read_corpus(spark, after))
    assert {r["status"] for r in none["pages"].collect()} == {"added"}


def test_gates(spark):
    answers = spark.createDataFrame([("a", 200, "x"), ("b", 200, None), ("c", 304, None), ("d", 304, None), ("e", 304, None), ("f", 404, "x"), ("g", None, None), (None, 304, None)], "k string, status int, html string")
    stored, raw = (spark.createDataFrame(rows, "k string") for rows in ([("c",), ("c",), (None,)], [("c",), ("d",)]))
    gates = lambda **o: {r["k"]: r["gate"] for r in settling.fetch_gate(answers, stored, raw, "k", **o).collect()}
    assert gates() == {"a": "parse", "b": "unreachable", "c": "skip", "d": "reread", "e": "failed", "f": "unreachable", "g": "unreachable", None: "failed"}
    assert gates(force=True)["c"] == "reread"
    was, now = spark.createDataFrame([("A", "1"), ("B", "1")], "c string, v string"), spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "1")], "c string, v string")
    versions = lambda **o: {r["c"]: r["gate"] for r in settling.version_gate(was, now, "c", "v", **o).collect()}
    assert versions() == {"A": "unchanged", "B": "moved", "C": "new"} and versions(force=True)["A"] == "moved"


def test_settled_again(spark):
    """A page that wasn't cut follows a heading that went, and one that came back."""
    stored = spark.createDataFrame([("k", "G/Part1/1/4", "href", "m", 0), ("k", "G/Part1/2", "regex", "m", 1), ("l", "G/Part9/9/9", "href", "m", 0), ("l", "G/Part1/1", "href", "m", 1)], "k string, ref string, extraction string, mention string, seq int")
    pages = spark.createDataFrame([("G/Part1/1",), ("G/Part1/2",)], "ref string")
    cut_pages, cut = spark.createDataFrame([("G/Part1/1",), ("G/Part1/3",)], "page string"), spark.createDataFrame([("G/Part1/1", "G/Part1/1/5")], "page string, ref string")
    old = spark.createDataFrame([("G/Part1/1", "G/Part1/1/4"), ("G/Part1/2", "G/Part1/2/1"), ("G/Part1/3", "G/Part1/3/1")], "page string, ref string")
    refs = settling.finished_inventory(cut_pages, cut, old, "page", "ref")
    assert sorted(r[0] for r in refs.collect()) == ["G/Part1/1/5", "G/Part1/2/1"]
    got = {tuple(r) for r in settling.resettled(stored, refs, pages, "k").collect()}
    assert got == {("k", "G/Part1/1/4", "href", "dropped"), ("k", "G/Part1/1", "href", "added"), ("l", "G/Part9/9/9", "href", "dropped")}


def test_documents_are_read_back(spark, tmp_path):
    root = held(tmp_path / "s", {
        "pages/a.json": page("G/Part1/1", "Part1", [chunk("G/Part1/1/2", "G/Part1/1", 2, "Two"), chunk("G/Part1/1/1", "G/Part1/1", 1, "One", provisions=[edge("B/s1"), edge("A/s1", None), edge("A/s1", "default")])]),
        "pages/b.json": page("G/Part2/1", "Part2", []),
    })
    corpus = read_corpus(spark, root)
    documents.write_documents(documents.page_documents(corpus.pages, corpus.chunks), str(tmp_path / "out/pages"), "part_id")
    again = read_corpus(spark, str(tmp_path / "out"))
    assert [tuple(r) for r in again.chunks.orderBy("seat").select("chunk_ref", "seat").collect()] == [("G/Part1/1/1", 0), ("G/Part1/1/2", 1)]
    assert [(e["id"], e["certainty"]) for e in again.chunks.where("ordinal = 1").first()["provisions"]] == [("A/s1", None), ("A/s1", "default"), ("B/s1", "explicit")]
    strip = lambda df: sorted(str(r) for r in df.drop("path").collect())
    assert strip(corpus.pages) == strip(again.pages)
    files = list((tmp_path / "out/pages").rglob("*.json"))
    assert len(files) == 2 and all(list(json.loads(f.read_text())) == ["chunks", "page"] for f in files)
    html = spark.createDataFrame([("a", "é\r\n<p>"), ("b", None)], "page_ref string, html string")
    documents.write_sources(html, "page_ref", "html", str(tmp_path / "raw"))
    assert sorted(map(tuple, documents.read_sources(spark, str(tmp_path / "raw"), "page_ref").collect())) == [("a", "é\r\n<p>"), ("b", None)]


def test_manifest(spark, tmp_path):
    none = spark.createDataFrame([], "page_ref string, url string, status int")
    made = lambda failed: documents.manifest(spark.sql("select 2 as pages, 3 as chunks"), spark.sql("select 1 as pages_written, true as complete"), failed, "v1", "t0", "t1")
    documents.write_documents(made(spark.createDataFrame([("b", "u", 404), ("a", "u", 500)], none.schema)), str(tmp_path / "manifest"))
    row = documents.read_manifest(spark, str(tmp_path / "manifest")).first()
    assert (row["extractor_version"], row["corpus"]["pages"], row["run"]["pages_written"], [x["page_ref"] for x in row["run"]["unreachable"]]) == ("v1", 2, 1, ["a", "b"])
    assert made(none).first()["run"]["unreachable"] == []
    assert documents.read_manifest(spark, str(tmp_path / "nowhere")).count() == 0


def test_nested_order(spark):
    df = spark.sql("select 1 as k, named_struct('b', array(named_struct('d', 1, 'c', cast(null as string))), 'a', map('z', 1, 'y', 2)) as x, cast(null as struct<q:int,p:int>) as n")
    assert canonical_json(df, "k").first()["json"] == '{"k":1,"n":null,"x":{"a":{"y":2,"z":1},"b":[{"c":null,"d":1}]}}'


def test_amendments(spark):
    title = "struct<titleId:string,name:string,provisions:string,seriesType:string,year:int,number:int>"
    kind = f"r array<struct<affect:string,markdown:string,affectedByTitle:{title},amendedByTitle:{title}>>"
    t = lambda i: (i, "N" + i, None, None, 2000, 1)
    df = spark.createDataFrame([([("B", "m", None, t("x")), None, ("A", "m", t(""), t("y")), ("A", "m", t("z"), t("y")), ("C", "m", None, None)],), (None,), ([],)], kind)
    got = [r[0] for r in df.select(documents.flat_amendments(F.col("r"))).collect()]
    assert [(x["affect"], x["title_id"], x["name"]) for x in got[0]] == [("A", "y", "Ny"), ("A", "z", "Nz"), ("B", "x", "Nx"), ("C", None, None)] and got[1:] == [None, []]


def test_unit_rules(spark):
    rows = [("p", 1, None, None, None), ("p", 2, 1, "(a)", None), ("p", 3, None, None, None), ("p", 4, 3, "(b)", None), ("q", 1, None, None, None), ("q", 2, 1, "(a)", None), ("q", 3, None, None, None), ("q", 4, 3, "(a)", None),
            ("q", 5, 4, None, None), ("r", 1, None, None, "term"), ("r", 2, 1, "(a)", None), ("r", 3, None, None, None), ("r", 4, 3, "(a)", None)]
    units = spark.createDataFrame(rows + rows[:3], "base string, ordinal int, parent int, number string, term string")
    assert {tuple(r) for r in structure.transparent(units, "base").collect()} == {("p", 1), ("p", 3), ("q", 5), ("r", 3)}
    span = "array<struct<text:string,start:int,end:int,weight:string>>"
    df = spark.createDataFrame([("\t(a)  two  words \n on", [("two  words ", 6, 17, "bold"), (" \n ", 16, 19, "bold"), ("(a)", 1, 4, "italic")], "definition"), ("Big  term means", [("Big  term", 0, 9, "bold-italic")], "definition"), ("", [], "text"), (None, None, None)], f"t string, s {span}, k string")
    got = df.select(structure.rebased(F.col("t"), F.col("s")).alias("s"), structure.defined_term(F.col("k"), F.col("s")).alias("d")).collect()
    assert [(x["text"], x["start"], x["end"]) for x in got[0]["s"]] == [("two words", 4, 13), ("(a)", 0, 3)]
    assert [r["d"] for r in got] == [None, "big-term", None, None] and [tuple(x) for x in got[1]["s"]] == [("Big term", 0, 8, "bold-italic")]
    wrong = spark.createDataFrame([("a b c", [("b", 0, 1, "bold")])], f"t string, s {span}")
    with pytest.raises(Exception, match="isn't where it says"):
        wrong.select(structure.rebased(F.col("t"), F.col("s"))).collect()
