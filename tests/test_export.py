"""The case export against its rules worked out one passage after another."""

import re

import pytest

from lexquarry.operators import export

CHUNK = (
    "chunk_ref string, page_ref string, part_id string, ordinal int, text string, heading_path array<string>, cases array<struct<id: string, citation: string>>, "
    "links array<struct<href: string, text: string>>, emphasis array<struct<kind: string, text: string, start: int, end: int>>"
)
PAGE = "page_ref string, h1 string, nav_title string, url string"
NC, RC = "[2018] FCAFC 109", "(1963) 109 CLR 407"


def chunk(ref, text, cites, links=(), emphasis=(), path=("One", "Two")):
    return (ref, "P", "Part1", 3, text, path, [(f"id {c}", c) for c in cites or ()], links, emphasis)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([("P", "", "Nav", "http://p")], PAGE)


def found(spark, pages, *chunks, strict=True):
    return {(r["chunk_ref"], r["citation"]): r for r in export.positions(spark.createDataFrame(list(chunks), CHUNK), pages, strict).collect()}


def test_shapes_names_and_neighbours(spark, pages):
    text = f"in Smith v Jones, {NC}; {RC}, 51 IPR 149 and {NC}"
    em = [("i", "Smith v", 3, 10), ("em", "Smith v Jones,", 3, 17), ("b", "Smith v Jones", 3, 16), ("i", "in", 0, 2)]
    rows = found(
        spark, pages, chunk("a", text, [NC, RC], emphasis=em), chunk("b", f"x {NC}", [NC], links=[("h", "no"), ("http://JADE.io/1", f"- A v B, {NC} and more")]),
        chunk("c", f"𝒳 {NC}", [NC], links=[("http://else", NC)], emphasis=None, path=None), chunk("d", None, [NC]), chunk("e", "nothing", []), ("f", "P", "Part1", 3, "", None, None, None, None),
        chunk("g", "y" * 500 + RC + "z" * 500, [RC]),
    )
    assert len(rows) == 5 and list(next(iter(rows.values())).asDict()) == export.COLUMNS
    a = rows["a", NC]
    assert (a["citation_style"], a["year"], a["court_or_series"], a["number"], a["volume"], a["first_page"]) == ("neutral", 2018, "FCAFC", "109", "", "")
    assert (a["parties"], a["parties_source"], a["occurrences_in_chunk"], a["char_offset"]) == ("Smith v Jones", "emphasis", 2, text.find(NC))
    assert (a["parallel_citation"], a["parallel_case_id"]) == (RC, f"id {RC}") and a["corpus_citation_count"] == 3
    b = rows["a", RC]
    assert (b["year"], b["volume"], b["court_or_series"], b["first_page"], b["number"], b["parties"]) == (1963, "109", "CLR", "407", "", "")
    assert (b["parallel_citation"], b["parallel_case_id"]) == (NC, f"id {NC}")  # pairs don't overlap: the third has none
    assert (rows["b", NC]["parties"], rows["b", NC]["parties_source"], rows["b", NC]["jade_href"]) == ("A v B", "anchor", "http://JADE.io/1")
    c = rows["c", NC]
    assert (c["parties"], c["jade_href"], c["char_offset"], c["part_title"], c["heading_path"], c["page_title"], c["url"]) == ("", "", 2, "", "", "Nav", "http://p")
    assert rows["g", RC]["context"] == "y" * 140 + RC + "z" * 140


def test_a_citation_that_is_not_there_or_of_no_shape(spark, pages):
    bad = [chunk("a", "text", [NC]), chunk("b", "[1990] 5", ["[1990] 5"]), chunk("c", f"x {NC}", [NC])]
    for one in bad[:2]:
        with pytest.raises(Exception, match="not in a|unparsed citation"):
            found(spark, pages, one)
    loose = found(spark, pages, *bad, strict=False)
    assert loose["a", NC]["char_offset"] is None and loose["b", "[1990] 5"]["year"] is None and len(loose) == 3
    told = {r["key"]: r["message"] for r in export.errors(spark.createDataFrame(bad, CHUNK)).collect()}
    assert told == {"a": f"'{NC}' not in a", "b": "unparsed citation '[1990] 5' on id [1990] 5"}


def test_names_by_emphasis_against_a_loop(spark, pages):
    words = ["A v B", "Re C", "D"]
    chunks, want = [], {}
    for i, gap in enumerate(["", " ", ", ", " (", "; (", " and ", "    ", ".", " "]):
        for j, w in enumerate(words):
            text = f"see {w}{gap}{NC}"
            chunks.append(chunk(f"{i} {j}", text, [NC], emphasis=[("i", w, 4, 4 + len(w)), ("em", w[:1], 4, 5)]))
            at = text.find(NC)
            ok = [s for s in ((4, 4 + len(w)), (4, 5)) if at - 3 <= s[1] <= at and re.fullmatch(r"[\s,;:(]*", text[s[1] : at])]
            want[f"{i} {j}", NC] = text[slice(*max(ok, key=lambda s: s[1] - s[0]))] if ok else ""
    assert {k: r["parties"] for k, r in found(spark, pages, *chunks).items()} == want
