"""Errors as a relation and as raises; ranks without a task that sorts a facet."""

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import errors, layout, relations
from lexquarry.sources.snapshot import SnapshotError, read_corpus
from tests.test_corpus import chunk, page
from tests.test_runs import held, nav


def told(df):
    return sorted((r["kind"], r["key"].rsplit("/", 1)[-1] if r["message"] == "not a page file" else r["key"], r["message"]) for r in df.collect())


def test_snapshot_errors(spark, tmp_path):
    files = {"pages/a.json": page("G/Part1/1", "Part1", [chunk("G/Part1/1/1", "G/Part1/1", 1, "One"), chunk("G/Part1/1/1", "G/Part1/1", 2, "Two")]), "pages/b.json": page("G/Part1/2", "Part1", []), "pages/c.json": ["no"], "pages/_retired/d.json": page("G/Part1/3", "Part1", [])}
    corpus = read_corpus(spark, held(tmp_path / "s", files | {"sitemap.json": nav(("u1", "G/Part1/1", "Part1", "One"))}))
    found = [errors.snapshot_errors(corpus), errors.collisions(corpus.chunks)]
    assert told(errors.raised(found, strict=False)) == [("ChunkRefCollision", "G/Part1/1/1", "several chunks claim this address"), ("SnapshotError", "G/Part1/2", "a live page that the inventory hasn't"), ("SnapshotError", "c.json", "not a page file")]
    with pytest.raises(SnapshotError, match="c.json: not a page file"):
        errors.raised(found)
    with pytest.raises(errors.ChunkRefCollision, match="G/Part1/1/1"):
        errors.raised(found[1:])
    bare = read_corpus(spark, held(tmp_path / "n", {"pages/a.json": page("G/Part1/1", "Part1", [])}))
    assert [x[2] for x in told(errors.snapshot_errors(bare))] == ["no page inventory", "a live page that the inventory hasn't"] or len(told(errors.snapshot_errors(bare))) == 2


def test_structure_unit_and_crawl_errors(spark):
    lines = [("ActHead2", "Part 1"), ("subsection", "early"), ("ActHead5", "4  A"), ("subsection", "x"), ("ActHead5", "4  B"), ("ActHead1", "Schedule 1"), ("ActHead5", "4  C"), ("Odd", "y"), ("Odd", "z"), ("ENotesHeading1", "Endnote 1"), ("ActHead5", "4  D")]
    rows = layout.segmented(spark.createDataFrame([("I", i, s, t) for i, (s, t) in enumerate(lines)], "instrument string, pos int, style string, text string"))
    assert told(errors.structure_errors(rows)) == [("StructureError", "I/1", "text below a container and above its first provision"), ("StructureError", "I/4", "a provision that is there twice")]
    assert told(errors.unit_errors(rows.where("style not like 'ActHead%' and style not like 'EN%'"), "instrument")) == [("UnitError", "I", "no unit has the style Odd")]
    gated = spark.createDataFrame([("u", "failed"), ("v", "skip")], "url string, gate string")
    with pytest.raises(errors.CrawlError, match="u: not modified"):
        errors.raised([errors.crawl_errors(gated, "url")])
    assert errors.raised([errors.crawl_errors(gated.where("gate = 'skip'"), "url")]).count() == 0


def test_ranks_of_many_values(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("facet"), F.when(F.col("id") % 7 > 0, (F.col("id") * F.col("id")) % 997).alias("value"))
    got = sorted(map(tuple, relations.ranked(df, "facet", "value").collect()))
    n = {}
    for r in df.collect():
        key = (r["facet"], "none" if r["value"] is None else str(r["value"]))
        n[key] = n.get(key, 0) + 1
    want = []
    for facet in ("a", "b"):
        want += [(*k, c, i) for i, (k, c) in enumerate(sorted(((k, c) for k, c in n.items() if k[0] == facet), key=lambda x: (-x[1], x[0][1])), 1)]
    assert got == sorted(want)
    one = spark.createDataFrame([(1, ["x", None], None), (2, None, "k")], "i int, l array<string>, k string")
    assert sorted(map(tuple, relations.facet_values(one, {"l": F.col("l"), "k": F.col("k")}).collect())) == [("k", "k"), ("k", "none"), ("l", "none"), ("l", "x")]
