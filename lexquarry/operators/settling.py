"""A run over an existing snapshot: which answers are read, which versions moved, and references settled again once all is cut.

A reference is a fact about two pages, so it is settled after every page is cut, against the whole inventory; pages
that the run didn't touch are settled again too, from what is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.snapshot import Corpus
from .changes import compared, with_retirement
from .inventory import settled
from .views import part_diff, readdressed, silent_amendments


def _held(keys: DataFrame, key: str, name: str) -> DataFrame:
    return keys.select(F.col(key).alias(f"_{name}_key")).distinct().withColumn(name, F.lit(True))


def fetch_gate(answers: DataFrame, stored: DataFrame, raw: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Adds ``gate`` to answers (key, status, html).

    ``parse`` reads the answer, ``skip`` leaves a page as it is (304, and its record is stored), ``reread`` reads the stored
    source of a 304, ``failed`` is a 304 without one, and any other answer is ``unreachable``. A run by force never skips.
    """
    out = answers.join(_held(stored, key, "_record"), F.col(key) == F.col("__record_key"), "left").join(_held(raw, key, "_raw"), F.col(key) == F.col("__raw_key"), "left")
    skip = F.col("_record") & F.lit(not force)
    unmoved = F.when(skip, "skip").when(F.col("_raw"), "reread").otherwise("failed")
    gate = F.when((F.col("status") == 200) & F.col("html").isNotNull(), "parse").when(F.col("status") == 304, unmoved).otherwise("unreachable")
    return out.withColumn("gate", gate).drop("_record", "_raw", "__record_key", "__raw_key")


def version_gate(stored: DataFrame, offered: DataFrame, code: str, version: str, force: bool = False) -> DataFrame:
    """Adds ``gate`` to the versions on offer: new, unchanged (the stored one; never by force) or moved."""
    was = stored.select(F.col(code).alias("_code"), F.col(version).alias("_was"))
    same = F.col(version).eqNullSafe(F.col("_was")) & F.lit(not force)
    return offered.join(was, F.col(code) == F.col("_code"), "left").withColumn("gate", F.when(F.col("_code").isNull(), "new").when(same, "unchanged").otherwise("moved")).drop("_code", "_was")


def finished_inventory(cut_pages: DataFrame, cut: DataFrame, stored: DataFrame, page: str, ref: str) -> DataFrame:
    """(ref) of every chunk that the snapshot will hold: those of the pages cut, and stored ones of all other pages."""
    others = stored.join(cut_pages.select(page).distinct(), page, "left_anti")
    return cut.select(ref).unionByName(others.select(ref)).distinct()


def resettled(stored: DataFrame, chunk_refs: DataFrame, page_refs: DataFrame, key: str) -> DataFrame:
    """(key, ref, extraction, change) of the references of untouched pages that settle on another target now.

    ``stored`` has (key, ref, extraction, mention, seq). Settling is repeatable, so a settled reference is its own candidate;
    rows are compared one by one, however many a key has.
    """
    edge = [key, "ref", "extraction"]
    before = stored.select(*edge).distinct().withColumn("_before", F.lit(True))
    after = settled(stored, chunk_refs, page_refs, key).select(*edge).distinct().withColumn("_after", F.lit(True))
    change = F.when(F.col("_before").isNull(), "added").when(F.col("_after").isNull(), "dropped")
    return before.join(after, edge, "full_outer").select(*edge, change.alias("change")).where("change is not null")


def page_states(corpus: Corpus, retired: bool = False) -> DataFrame:
    """The pages of a snapshot as a comparison sees them; ``body`` also moves when any chunk does. An absent folder has none."""
    of = F.col("retired") == F.lit(retired)
    lists = F.array_sort(F.collect_list(F.struct("chunk_ref", "content_hash")))
    chunks = corpus.chunks.where(of).groupBy(F.col("page_ref").alias("_page")).agg(F.sha2(F.to_json(lists), 256).alias("_chunks"))
    pages = corpus.pages.where(of).join(chunks, F.col("page_ref") == F.col("_page"), "left")
    log = F.struct("last_amended", "amendment_note")
    fields = ("h1", "nav_title", "url", "date_published", "last_amended", "amendment_note", "extractor_version", "archived")
    return pages.select("page_ref", "part_id", F.concat_ws("/", "content_hash", "_chunks").alias("body"), F.col("content_hash").alias("page_hash"), log.alias("log"), *fields)


FIELDS = ["h1", "nav_title", "url", "date_published", "last_amended", "amendment_note", "extractor_version", "archived"]


def compared_corpora(before: Corpus, after: Corpus) -> dict[str, DataFrame]:
    """What moved between two snapshots: pages, parts, urls at another address, and amendments that the pages' own log doesn't tell."""
    was, now = page_states(before), page_states(after)
    pages = with_retirement(compared(was, now, "page_ref", "body", FIELDS), page_states(before, True), page_states(after, True), "page_ref")
    parts = [c.nav.groupBy("part_id").agg(F.max("part_title").alias("title"), F.count(F.lit(1)).alias("n")) for c in (before, after)]
    moved = readdressed(*[c.nav.groupBy("url").agg(F.min("page_ref").alias("page_ref")) for c in (before, after)], "url", "page_ref")
    return {"pages": pages, "parts": part_diff(*parts, "part_id"), "readdressed": moved, "silent": silent_amendments(was, now, "page_ref", "page_hash", "log")}
