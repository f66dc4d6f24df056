"""Runs that publish by one commit, tables that grow by deltas, and files written only where content moved."""

import json

import pytest

from lexquarry.functions import markup
from lexquarry.operators import runs
from lexquarry.plans import catalog
from lexquarry.plans import runs as _  # noqa: F401  (registers its queries)
from lexquarry.sources import publish

NAV = [("M/Part1/1", "Part1", "http://h/1"), ("M/Part1/2", "Part1", "http://h/2"), ("M/Part2/1", "Part2", "http://h/3")]
HTML = {1: "<main><h2>1.1 Head</h2><p>See <a href='http://h/2#1.2-there'>two</a> and <a href='http://h/3'>three</a></p></main>", 2: "<main><h2>1.2 There</h2><p>words</p></main>", 3: "<main><p>alone</p></main>"}


def frames(spark, answers, nav=NAV):
    return spark.createDataFrame(nav, "page_ref string, part_id string, url string"), spark.createDataFrame(answers, "url string, status int, html string")


def rows(store, name):
    return sorted(tuple(r) for r in store.table(name, runs.TABLES[name]).collect())


def all_read():
    return [(f"http://h/{i}", 200, x) for i, x in HTML.items()]


@pytest.fixture
def store(spark, tmp_path):
    return publish.Store(spark, f"file://{tmp_path}/store")


def test_a_second_run_writes_nothing(spark, store):
    first = runs.carried_out(store, "a", "t1", *frames(spark, all_read() + [("http://h/9", 200, "x"), (None, 200, "x"), ("http://h/1", 500, None)]))
    assert first["pages"] == 3 and first["refs"] == 2
    assert [(r[0], r[1]) for r in rows(store, "refs")] == [("M/Part1/1", "M/Part1/2/1/2"), ("M/Part1/1", "M/Part2/1")]
    assert runs.carried_out(store, "a", "t2", *frames(spark, [("http://h/1", 200, "other")])) == {}  # committed already
    assert runs.carried_out(store, "b", "t2", *frames(spark, all_read())) == {} and runs.carried_out(store, "c", "t2", *frames(spark, [(u, 304, None) for u, _, _ in all_read()])) == {}
    assert len(store.commits()) == 1 and {r[4] for r in rows(store, "pages")} == {"t1"}


def test_only_what_moved_is_stamped_and_references_follow(spark, store):
    runs.carried_out(store, "a", "t1", *frames(spark, all_read()))
    moved = runs.carried_out(store, "b", "t2", *frames(spark, [("http://h/2", 200, "<main><h2>9 Other</h2><p>x</p></main>"), ("http://h/1", 304, None), ("http://h/3", 404, None)]))
    assert moved["sources"] == 1 and "retired" not in moved  # one page of html, not all
    assert {r[0]: r[4:] for r in rows(store, "pages")} == {"M/Part1/1": ("t1", "t1"), "M/Part1/2": ("t2", "t1"), "M/Part2/1": ("t1", "t1")}
    assert [r[1] for r in rows(store, "refs")] == ["M/Part1/2", "M/Part2/1"] and rows(store, "unreachable") == [("http://h/3", 404)]  # the heading went: the page itself
    runs.carried_out(store, "c", "t3", *frames(spark, [("http://h/2", 200, HTML[2]), ("http://h/3", 200, HTML[3])]))
    assert [r[1] for r in rows(store, "refs")] == ["M/Part1/2/1/2", "M/Part2/1"] and rows(store, "unreachable") == []
    assert sorted(r[0] for r in rows(store, "sources")) == [f"http://h/{i}" for i in (1, 2, 3)] and dict(rows(store, "sources"))["http://h/2"] == HTML[2]


def test_a_run_walks_markup_once(spark, store, monkeypatch):
    walks, whole = [], markup._mapped
    monkeypatch.setattr(markup, "_mapped", lambda pages, *x: walks.append(pages.columns) or whole(pages, *x))
    nav = [*NAV, ("M/Part1/0", "Part1", "http://h/3"), ("M/Part9/1", "Part9", "http://h/8")]
    runs.carried_out(store, "a", "t1", *frames(spark, [*all_read(), ("http://h/8", 500, None), ("http://h/7", 500, None)], nav))
    assert len(walks) == 1
    assert [r[:2] for r in rows(store, "chunks")] == [("M/Part1/0", "M/Part1/0/#1"), ("M/Part1/1", "M/Part1/1/1/1"), ("M/Part1/2", "M/Part1/2/1/2"), ("M/Part2/1", "M/Part2/1/#1")]
    assert [r[1] for r in rows(store, "refs")] == ["M/Part1/0", "M/Part1/2/1/2"]  # of two pages of a url the first
    assert len(rows(store, "sources")) == 3 and rows(store, "unreachable") == [("http://h/8", 500)]
    before = {name: rows(store, name) for name in runs.TABLES}
    assert runs.carried_out(store, "b", "t2", *frames(spark, [("http://h/3", 304, None), ("http://h/1", 304, None)], nav), force=True) == {}
    assert {name: rows(store, name) for name in runs.TABLES} == before and len(walks) == 2


def test_the_query_leaves_its_tables_only(spark, monkeypatch):
    stores, whole = [], publish.Store.commits
    monkeypatch.setattr(publish.Store, "commits", lambda self: stores.append(self) or whole(self))
    assert catalog.QUERIES["published_run"](spark, "/root/testdata/sf0.001").count() > 0
    assert stores[-1].swept() == []


def test_pages_retire_with_a_complete_run_and_come_back(spark, store):
    runs.carried_out(store, "a", "t1", *frames(spark, all_read()))
    runs.carried_out(store, "b", "t2", *frames(spark, [], NAV[:2]), complete=False)
    assert rows(store, "retired") == []
    runs.carried_out(store, "c", "t3", *frames(spark, [], NAV[:2]))
    assert rows(store, "retired") == [("M/Part2/1", "t3")] and [r[1] for r in rows(store, "refs")] == ["M/Part1/2/1/2"]
    runs.carried_out(store, "d", "t4", *frames(spark, []))
    assert rows(store, "retired") == [] and len(rows(store, "refs")) == 2


def test_a_run_killed_before_its_commit_leaves_the_version_before(spark, store, monkeypatch):
    runs.carried_out(store, "a", "t1", *frames(spark, all_read()))
    before = {name: rows(store, name) for name in runs.TABLES}
    moved = frames(spark, [("http://h/1", 200, HTML[1] + "<p>more</p>")])
    with monkeypatch.context() as m:
        m.setattr(publish.Store, "_commit", lambda *x: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            runs.carried_out(store, "b", "t2", *moved)
    assert {name: rows(store, name) for name in runs.TABLES} == before
    assert runs.carried_out(store, "b", "t2", *moved)["pages"] == 3 and {r[4] for r in rows(store, "pages")} == {"t1", "t2"}
    after = {name: rows(store, name) for name in runs.TABLES}
    assert store.swept(keep=1) and not store.swept(keep=1) and {name: rows(store, name) for name in runs.TABLES} == after


def test_deltas_hide_older_rows_and_are_put_together(spark, store):
    for i in range(5):
        delta = spark.createDataFrame([(k, i) for k in range(i, 4)], "k long, v int")
        moved = store.publish(f"r{i}", "t", {}, {"d": (delta, "k")}, most=3)
        assert moved == ({"d": 4 - i} if i < 4 else {})
    assert sorted(map(tuple, store.table("d", "k long, v int").collect())) == [(k, k) for k in range(4)]
    assert len(store.commits()[-1]["tables"]["d"]["paths"]) < 4


def test_files_are_written_where_content_moved(spark, tmp_path):
    docs = spark.createDataFrame([("I/s1", "I", "é1"), ("I/s2", "I", "2"), ("J/s1(a)", None, "3"), (None, "I", "x"), ("I/s9", "I", None)], "key string, part string, content string")
    none = spark.createDataFrame([], "key string, digest string")
    folder = f"file://{tmp_path}/out"
    first = publish.write_files(docs, none, folder).collect()
    assert sorted(r["file"] for r in first) == ["I/I-s1.json", "I/I-s2.json", "J-s1(a).json"] and (tmp_path / "out/I/I-s1.json").read_text() == "é1"
    stamps = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*.json")}
    stored = spark.createDataFrame([(r["key"], r["digest"]) for r in first], none.schema)
    again = publish.write_files(docs.replace("2", "two", "content"), stored, folder).collect()
    assert [r["file"] for r in again] == ["I/I-s2.json"] and (tmp_path / "out/I/I-s2.json").read_text() == "two"
    assert all(p.stat().st_mtime_ns == t for p, t in stamps.items() if p.name != "I-s2.json") and len(list((tmp_path / "out").rglob("*"))) == 4
    assert json.dumps([r["key"] for r in again]) == '["I/s2"]'
