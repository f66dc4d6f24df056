"""What an earlier run wrote stays, ids stay whole, and white space of any kind stands between words."""

from lexquarry.functions import markup
from lexquarry.operators import citing, provisions
from lexquarry.sources import documents
from lexquarry.sources.snapshot import read_corpus
from tests.test_corpus import chunk, page
from tests.test_runs import held

BIG = (1 << 60) + 1, (1 << 60) + 3


def test_parts_that_were_not_given_stay(spark, tmp_path):
    root = held(tmp_path / "s", {"pages/a.json": page("G/Part1/1", "Part1", [chunk("G/Part1/1/1", "G/Part1/1", 1, "One")]), "pages/b.json": page("G/Part2/1", "Part2", []), "pages/c.json": page("G/Part1/2", "Part1", [])})
    corpus, out = read_corpus(spark, root), str(tmp_path / "out/pages")
    rows = documents.page_documents(corpus.pages, corpus.chunks)
    documents.write_documents(rows, out, "part_id")
    documents.write_documents(rows.where("page.page_ref = 'G/Part1/1'"), out, "part_id")
    assert sorted(r[0] for r in read_corpus(spark, str(tmp_path / "out")).pages.select("page_ref").collect()) == ["G/Part1/1", "G/Part2/1"]


def test_ids_stay_whole_beside_null(spark):
    html = "<nav><ul><li><a href='/x'>N</a></li></ul></nav><main><h2>H</h2><p>a <a href='/l'>b</a> <b>c</b></p><table><tr><td>1</td></tr></table><img src='i'></main>"
    pages = spark.createDataFrame([(BIG[0], html), (BIG[1], html), (None, html)], "page_id long, html string").coalesce(1)
    for f in (markup.page_blocks, markup.page_spans, markup.page_chunks, markup.page_tables, markup.page_images, markup.nav_entries):
        assert {r["page_id"] for r in f(pages).collect()} == {*BIG, None}, f.__name__
    assert markup.page_tables(pages).first()["cells"][0][0]["text"] == "1"
    assert markup.page_blocks(spark.createDataFrame([(1, None)], "page_id long, html string")).count() == 0


def test_no_break_spaces(spark):
    texts = ["See section\xa041 of the Trade Marks Act 1995.", "section 41 of the Trade Marks Act 1995", "ésection 9"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {(r["k"], r["id"], r["certainty"]) for r in provisions.cited_provisions(docs, spark.createDataFrame([], "k int, href string, words string, seq int"), "k", "t").collect()}
    assert got == {(0, "TMA1995/s41", "explicit"), (1, "TMA1995/s41", "explicit")}


def test_items_of_any_length_are_found(spark):
    texts = ["one two three four five six", "the cat\nsat on 🙂🙂 mats", "", None, "aaaaaaaaaaaaab", "abc", "ab\x00cd" * 9, "one two three four"]
    items = ["two three four five six", "wo three f", "at\nsat", "🙂", "🙂🙂 m", "", "aaaab", "abc", "abcd", "b", None, "\x00cda", "four five", "one two three four five six seven", " "]
    docs, own = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), spark.createDataFrame(list(enumerate(items)), "item_id int, item string")
    got = citing.contained(docs, own, "text", "item").select("doc_id", "item_id").collect()
    assert sorted(map(tuple, got)) == sorted((i, j) for i, t in enumerate(texts) for j, x in enumerate(items) if t is not None and x is not None and x in t)
