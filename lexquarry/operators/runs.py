"""One run over a store: read what was fetched, cut, settle, stamp, retire, publish.

References are settled after all pages are cut, against the inventory that the store will hold; those of pages that the run didn't touch are settled
again from the candidates that are stored, so a target that goes or comes back moves them. All tables become visible by one commit. Nothing is written
for a run that moves nothing, and a run killed before its commit leaves the version before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.text import digest
from ..sources.publish import Store
from .changes import merged, retired
from .inventory import link_candidates, settled
from .settling import fetch_gate

TABLES = {
    "sources": "url STRING, html STRING",
    "pages": "page_ref STRING, part_id STRING, url STRING, digest STRING, crawled_at STRING, first_seen STRING",
    "chunks": "page_ref STRING, chunk_ref STRING, ordinal INT, text STRING, content_hash STRING",
    "candidates": "page_ref STRING, ref STRING, extraction STRING, mention STRING, seq LONG",
    "refs": "page_ref STRING, ref STRING, extraction STRING, mention STRING, seq LONG",
    "retired": "page_ref STRING, retired_at STRING",
    "unreachable": "url STRING, status INT",
}


def others(stored: DataFrame, touched: DataFrame, key: str) -> DataFrame:
    """The stored rows of keys that this run didn't touch."""
    return stored.join(touched.select(key).distinct(), key, "left_anti")


def carried_out(store: Store, run: str, now: str, nav: DataFrame, answers: DataFrame, complete: bool = True, force: bool = False, base: str = "") -> dict[str, int]:
    """Carries out a run over answers (url, status, html) to the pages of ``nav`` (page_ref, part_id, url); returns the rows written by table.

    A 304 leaves a stored page as it is (by force its stored source is read again), other statuses make a page unreachable; stamps move
    with content only. Pages that the nav hasn't any more are retired, by a complete run only, and come back with it. Of repeated answers to
    a url the largest html counts; answers that the nav doesn't know, and null urls, are left out. A run whose name was committed does nothing.
    """
    commits = store.commits()
    if any(c["run"] == run for c in commits):
        return {}
    held = {name: store.table(name, schema, commits[-1] if commits else {"tables": {}}) for name, schema in TABLES.items()}
    nav = nav.select("page_ref", "part_id", "url").where("page_ref is not null and url is not null").dropDuplicates(["page_ref"])
    nav = store.aside(nav, run, "nav")
    nav = nav.join(nav.groupBy("url").agg(F.min("page_ref").alias("_lead")), "url").withColumn("lead", F.col("page_ref") == F.col("_lead")).drop("_lead")
    one = answers.where("url is not null").groupBy("url").agg(F.max_by(F.struct("status", "html"), F.struct(F.col("status") == 200, "html", "status")).alias("x")).select("url", "x.*")
    # One row a page (``lead`` is the first of its url), with the html to be cut; what follows needs digests only.
    was = held["sources"].select("url", F.sha2("html", 256).alias("_was"))
    gated = fetch_gate(one, held["pages"], held["sources"], "url", force).join(was, "url", "left").join(nav, "url", "left")
    parse = F.col("gate") == "parse"
    gated = gated.withColumn("digest", F.when(parse, F.sha2("html", 256)).when(F.col("gate") == "reread", F.col("_was"))).withColumn("moved", parse & ~F.col("digest").eqNullSafe(F.col("_was")))
    gated = store.aside(gated.withColumn("html", F.when(parse & F.col("page_ref").isNotNull(), F.col("html"))).drop("_was"), run, "gated")
    fresh = gated.where("gate in ('parse', 'reread') and page_ref is not null").select("page_ref", "part_id", "url", "digest")
    read = gated.where("gate = 'parse' and page_ref is not null").select("page_ref", "html")
    again = gated.where("gate = 'reread' and page_ref is not null").select("page_ref", "url")
    if not again.isEmpty():
        read = read.unionByName(again.join(held["sources"], "url").select("page_ref", "html"))

    # Cut.
    first = held["pages"].select("page_ref", F.col("first_seen").alias("_first"))
    kept = merged(held["pages"].drop("first_seen"), fresh.withColumn("crawled_at", F.lit(now)), "page_ref", ["part_id", "url", "digest"], "crawled_at", now)
    kept = kept.join(first, "page_ref", "left").select("page_ref", "part_id", "url", "digest", "crawled_at", F.coalesce("_first", F.lit(now)).alias("first_seen"))
    kept = store.aside(kept, run, "kept")
    parts = store.aside(markup.page_parts(read.withColumn("page_id", F.col("page_ref"))).withColumnRenamed("page_id", "page_ref"), run, "cut")
    cut = parts.where("chunk_ref is not null").select("page_ref", "chunk_ref", "ordinal", "text", digest(F.col("text")).alias("content_hash"))
    chunks = cut.unionByName(others(held["chunks"], fresh, "page_ref"))
    links = parts.where("href is not null").select(F.col("page_ref").alias("citing"), "href", "words", F.col("start").cast("long").alias("seq"))
    found = link_candidates(links, nav.where("lead"), "citing", base).select(F.col("citing").alias("page_ref"), "ref", "extraction", "mention", "seq")
    candidates = store.aside(found, run, "found").unionByName(others(held["candidates"], fresh, "page_ref"))

    # Settle, against pages that the nav still has; a run in part takes those that were there before, too.
    gone = retired(kept, nav, "page_ref", held["retired"], now) if complete else others(held["retired"], nav, "page_ref")
    gone = store.aside(gone, run, "gone")
    live = kept.join(gone, "page_ref", "left_anti").select("page_ref")
    inventory = chunks.join(live, "page_ref", "left_semi").select(F.col("chunk_ref").alias("ref"))
    refs = settled(candidates.join(live, "page_ref", "left_semi"), inventory, live.select(F.col("page_ref").alias("ref")), "page_ref").select("page_ref", "ref", "extraction", "mention", "seq")

    failed = gated.where("gate in ('unreachable', 'failed') and lead").select("url", "status")
    earlier = others(held["unreachable"], gated, "url").join(nav, "url", "left_semi")
    moved = gated.where("moved and lead").select("url", "html")
    whole = {"pages": kept, "chunks": chunks, "candidates": candidates, "refs": refs, "retired": gone, "unreachable": failed.unionByName(earlier)}
    return store.publish(run, now, whole, {"sources": (moved, "url")})
