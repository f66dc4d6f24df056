"""Snapshot reading, validation, search, bundles, on a snapshot made here."""

import hashlib
import json

import pytest

from lexquarry.operators import bundle, search, validate
from lexquarry.sources.snapshot import SnapshotError, canonical_json, read_corpus, write_changed


def sha(text):
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def chunk(ref, page, ordinal, text, **more):
    base = {"chunk_ref": ref, "page_ref": page, "ordinal": ordinal, "text": text, "content_hash": sha(text), "kind": "body", "heading_source": None, "heading_path": ["Guide", "Page"], "headings": [],
            "blocks": [{"kind": "paragraph", "text": text}], "links": [], "emphasis": [], "tables": [], "provisions": [], "cases": [], "internal_refs": []}
    return base | more


def page(ref, part, chunks, **more):
    base = {"page_ref": ref, "part_id": part, "url": f"https://x/{ref}", "nav_title": ref, "content_hash": sha(ref), "crawled_at": "2024-01-01T00:00:00Z", "amendments": [], "archived": False, "images": []}
    return {"page": base | more, "chunks": chunks}


def edge(i, certainty="explicit", extraction="regex"):
    return {"id": i, "extraction": extraction, "certainty": certainty, "mention": i}


def provision(ref, units):
    text = " ".join(u["text"] for u in units)
    return {"ref": ref, "instrument": ref.split("/")[0], "kind": "section", "number": ref.split("/s")[-1], "title": "T", "containers": [], "heading_path": [], "text": text, "content_hash": sha(text), "units": units}


def unit(ref, ordinal, text, parent=None, **more):
    return {"ref": ref, "parent_ref": parent, "ordinal": ordinal, "depth": 1, "kind": "subsection", "number": str(ordinal), "text": text, "content_hash": sha(text)} | more


@pytest.fixture
def root(tmp_path):
    files = {
        "pages/Part1/G-Part1-1.json": page("G/Part1/1", "Part1", [
            chunk("G/Part1/1/1", "G/Part1/1", 1, "See section 41 of [1999] ABC 5 now", provisions=[edge("EXA2001/s41"), edge("EXA2001/s999", "default")], cases=[{"id": "abc-5", "citation": "[1999] ABC 5"}],
                  internal_refs=[{"ref": "G/Part2/1", "extraction": "href", "mention": "x"}], emphasis=[{"kind": "em", "text": "of", "start": 15, "end": 17}], links=[{"href": "h", "text": "section 41", "start": 4, "end": 14}]),
            chunk("G/Part1/1/2", "G/Part1/1", 2, "Other words", provisions=[edge("EXA2001/s41(1)(a)", "explicit", "href"), edge("FOREIGN/s1")], internal_refs=[{"ref": "G/Part2/1/1", "extraction": "regex", "mention": "y"}, {"ref": "G/Part1/1", "extraction": "regex", "mention": "z"}]),
        ], last_amended="2023-05-01", amendments=[{"date": "2023-05-01", "reason": None}]),
        "pages/Part2/G-Part2-1.json": page("G/Part2/1", "Part2", [chunk("G/Part2/1/1", "G/Part2/1", 1, "Plain")]),
        "pages/_retired/G-Part3-1.json": page("G/Part3/1", "Part3", []),
        "sitemap.json": {"parts": [], "pages": [{"url": "u", "page_ref": "G/Part1/1", "part_id": "Part1", "part_title": "One", "nav_title": "a", "kind": "body", "nav_ordinal": 1}]},
        "legislation/EXA2001/provisions/EXA2001-s41.json": provision("EXA2001/s41", [unit("EXA2001/s41(1)", 1, "First", provisions=[edge("EXA2001/s42")]), unit("EXA2001/s41(1)(a)", 2, "Second", "EXA2001/s41(1)")]),
        "legislation/EXA2001/provisions/EXA2001-s42.json": provision("EXA2001/s42", [unit("EXA2001/s42(1)", 1, "Third")]),
        "legislation/EXA2001/contents.json": {"instrument": "EXA2001", "containers": [], "provisions": [{"ref": "EXA2001/s41", "ordinal": 1}, {"ref": "EXA2001/s42", "ordinal": 2}]},
    }
    for name, value in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(value))
    return tmp_path


def test_sound_snapshot_has_no_failures(spark, root):
    corpus = read_corpus(spark, str(root)).strict()
    assert [r.asDict() for r in validate.failures(corpus).collect()] == []
    assert corpus.pages.where("retired").count() == 1 and corpus.chunks.count() == 3 and corpus.units.count() == 3


@pytest.mark.parametrize(("change", "check"), [
    (lambda c: c.update(content_hash="sha256:0"), "hash"),
    (lambda c: c["links"][0].update(start=5), "links"),
    (lambda c: c["emphasis"][0].update(end=15), "emphasis"),
    (lambda c: c["blocks"][0].update(text="no"), "blocks"),
    (lambda c: c.update(ordinal=7), "ordinal"),
    (lambda c: c["internal_refs"][0].update(ref="G/Nowhere"), "reference"),
    (lambda c: c["provisions"].append(edge("EXA2001/s41")), "edges"),
    (lambda c: c.update(chunk_ref="G/Part1/1/2"), "unique"),
])
def test_each_broken_invariant_is_told(spark, root, change, check):
    path = root / "pages/Part1/G-Part1-1.json"
    document = json.loads(path.read_text())
    change(document["chunks"][0])
    path.write_text(json.dumps(document))
    assert {r["check"] for r in validate.failures(read_corpus(spark, str(root))).collect()} == {check}


def test_corrupt_files_are_rows_and_strict_raises(spark, root):
    (root / "pages/Part2/bad.json").write_text("{")
    corpus = read_corpus(spark, str(root))
    assert corpus.corrupt.count() == 1 and corpus.pages.count() == 3
    with pytest.raises(SnapshotError):
        corpus.strict()


def test_missing_folders_are_empty(spark, tmp_path):
    corpus = read_corpus(spark, str(tmp_path))
    assert corpus.pages.isEmpty() and corpus.provisions.isEmpty() and corpus.nav.isEmpty()


def test_cross_corpus_join_and_graph(spark, root):
    corpus = read_corpus(spark, str(root))
    assert bundle.cross_report(corpus).first().asDict() == {"edges": 3, "resolved": 2, "unresolved_refs": 1}
    owners = {r["id"]: r["owner"] for r in bundle.cross_references(corpus).collect()}
    assert owners["EXA2001/s41(1)(a)"] == "EXA2001/s41" and owners["EXA2001/s999"] is None
    nodes, edges = bundle.citation_graph(corpus)
    assert {(r["source"], r["target"], r["kind"]): r["weight"] for r in edges.collect()} == {
        ("Part1", "Part2", "manual_to_manual"): 2, ("Part1", "EXA2001/s41", "manual_to_law"): 2, ("EXA2001/s41", "EXA2001/s42", "law_to_law"): 1}
    assert {r["id"]: r["degree"] for r in nodes.collect()} == {"Part1": 4, "Part2": 2, "Part3": 0, "EXA2001/s41": 3, "EXA2001/s42": 1}


def test_facets_parts_and_cases(spark, root):
    corpus = read_corpus(spark, str(root))
    found = {(r["facet"], r["value"]): r["n"] for r in bundle.facets(corpus).collect()}
    assert found["instrument", "EXA2001"] == 3 and found["certainty", "default"] == 1 and found["heading_source", "none"] == 3 and found["year", "2023"] == 1
    assert {r["part_id"]: (r["title"], r["pages"], r["chunks"]) for r in bundle.parts(corpus).collect()} == {"Part1": ("One", 1, 2), "Part2": ("Part2", 1, 1), "Part3": ("Part3", 1, 0)}
    case = bundle.case_rows(corpus).first()
    assert (case["year"], case["court_or_series"], case["number"], case["parties"], case["corpus_citation_count"]) == (1999, "ABC", "5", "of", 1)


@pytest.mark.parametrize(("question", "n", "law"), [
    (search.Question(), 3, 2), (search.Question(parts=("Part2",)), 1, 0), (search.Question(provision="S41"), 2, 1), (search.Question(certainty=("default",)), 1, 0),
    (search.Question(extraction=("href",), certainty=("explicit",)), 1, 0), (search.Question(case="abc"), 1, 0), (search.Question(text="PLAIN"), 1, 0), (search.Question(corpus=("legislation",)), 0, 2),
    (search.Question(years=("2023",)), 2, 0), (search.Question(cited="yes"), 1, 1), (search.Question(refs="part2"), 2, 0), (search.Question(fragment="yes"), 0, 0), (search.Question(text="third"), 0, 1),
])
def test_questions(spark, root, question, n, law):
    found = search.search(read_corpus(spark, str(root)), question)
    assert (found["manual"].count(), found["legislation"].count()) == (n, law)
    assert search.Question.from_params(question.to_params()) == question


def test_second_write_changes_nothing(spark, tmp_path):
    rows = canonical_json(spark.createDataFrame([("a", 1, "p"), ("b", 2, "p")], "ref string, n int, part string"), "ref").selectExpr("*", "'p' part")
    assert write_changed(rows, rows.limit(0), "ref", str(tmp_path / "out"), "part").count() == 2
    assert write_changed(rows, spark.read.parquet(str(tmp_path / "out")), "ref", str(tmp_path / "out"), "part").count() == 0
