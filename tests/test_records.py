"""Page records, the inventory, settling and reports."""

from lexquarry.functions import records
from lexquarry.operators import changes, inventory, report

PAGE = """<html><head><link rel="canonical" href="http://s/a"></head><body><main><div class="block-page-title-block"><h1>Part 22.1 Title</h1></div>
<div class="py-3"><strong>Date Published</strong><time datetime="2020-01-02T23:30:00+11:00">x</time></div>
<div class="view-amended-reasons"><table><tbody>
<tr><td class="views-field-field-amended-reason">old</td><td class="views-field-field-date-amended"><time datetime="2021-01-01T00:00:00Z">x</time></td></tr>
<tr><td class="views-field-field-amended-reason"> </td><td class="views-field-field-date-amended"><time datetime="2022-01-01T00:00:00Z">x</time></td></tr></tbody></table></div>
<div class="field--name-body"><p>Text <img src="b"><img src="b" alt=""><img src="a" alt="z"></p></div></main></body></html>"""


def test_records(spark):
    bad = PAGE.replace("2020-01-02T23:30:00+11:00", "soon")
    rows = [("http://s/a", PAGE), ("http://s/b", PAGE), ("http://s/a", bad), ("x", "<main></main>"), ("y", None)]
    got = records.page_records(spark.createDataFrame(rows, "url string, html string")).collect()
    good = next(r for r in got if r["problem"] is None)
    assert (good["h1"], good["date_published"], good["last_amended"], good["amendment_note"]) == ("Part 22.1 Title", "2020-01-02", "2022-01-01", None)
    assert [a["reason"] for a in good["amendments"]] == [None, "old"] and [(i["src"], i["alt"]) for i in good["images"]] == [("a", "z"), ("b", None), ("b", "")]
    assert sorted(r["problem"].split(" ")[0] for r in got if r["problem"]) == ["Invalid", "no", "no", "this"]


def test_inventory(spark):
    rows = [("n", 0, 1, "Part 1 Start", "/p1"), ("n", 1, 2, "1.2 More", "/p1/2"), ("n", 2, 2, "Annex A", "/p1/a/"), ("n", 3, 1, "Part 2", "/p2"), ("m", 0, 1, "Lost", "/x")]
    pages = inventory.inventory(spark.createDataFrame(rows, "nav string, pos int, depth int, title string, href string"), "G", "http://s")
    got = [(r["page_ref"], r["kind"], r["nav_ordinal"], r["url"]) for r in pages.where("nav = 'n'").orderBy("pos").collect()]
    assert got == [("G/Part1", "landing", 1, "http://s/p1"), ("G/Part1/2", "body", 2, "http://s/p1/2"), ("G/Part1/annex-a", "annex", 3, "http://s/p1/a"), ("G/Part2", "landing", 1, "http://s/p2")]
    assert [(r["check"], r["where"]) for r in inventory.inventory_problems(pages).collect()] == [("part", "Lost")]


def test_settling_is_idempotent(spark):
    links = spark.createDataFrame([("c", "http://s/p#1.2", "a", 0), ("c", "/p", "b", 1), ("c", "/p#none", "d", 2), ("c", "/elsewhere", "e", 3), ("c", "/p#frag", "f", 4)], "chunk string, href string, words string, seq int")
    pages = spark.createDataFrame([("http://s/p", "G/Part1/2")], "url string, page_ref string")
    found = inventory.link_candidates(links, pages, "chunk", "http://s")
    chunks = spark.createDataFrame([("G/Part1/2/1/2",), ("G/Part1/2/frag~1",), ("G/Part1/2/frag~2",)], "ref string")
    refs = pages.selectExpr("page_ref ref")
    once = inventory.settled(found, chunks, refs, "chunk")
    assert {(r["ref"], r["mention"]) for r in once.collect()} == {("G/Part1/2/1/2", "a"), ("G/Part1/2", "b"), ("G/Part1/2/frag~1", "f")}
    assert sorted(map(tuple, inventory.settled(once, chunks, refs, "chunk").select(*sorted(once.columns)).collect())) == sorted(map(tuple, once.select(*sorted(once.columns)).collect()))


def test_report(spark):
    state = lambda rows: spark.createDataFrame(rows, "ref string, body string, title string")
    before, after = state([("P/10", "a", "x"), ("P/2", "b", "y"), ("P/3", "c", "z")]), state([("P/10", "a2", "x"), ("P/2", "b", "y|2"), ("P/4", "d", "w")])
    text = report.change_report(changes.compared(before, after, "ref", "body", ["title"]), "ref", "one", "two", after)
    assert "1 page added, 1 page amended, 1 page reworded, 1 page vanished; 0 pages unchanged." in text
    assert "- P/4 w" in text and "| P/2 | title |" in text and "- P/3" in text
    same = changes.compared(before, before, "ref", "body", ["title"])
    assert "Nothing changed." in report.change_report(same, "ref", "one", "one")
    assert "- a (500)" in report.run_report({"pages_seen": 1200}, spark.createDataFrame([("a", 500)], "url string, status int"))
