"""All that is wrong with a corpus, a cut or a run as one relation (kind, key, message), which the driver looks at once: strict callers raise, others read on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.snapshot import Corpus, SnapshotError
from .layout import CONTAINERS, ENDNOTES, ITEM, PROVISION
from .units import NOTES, STYLES, UnitError

ERROR = "kind string, key string, message string"


class ChunkRefCollision(ValueError):
    """Two chunks claim one address."""


class StructureError(ValueError):
    """A provision that is there twice, or a table, heading or text that no provision holds."""


class CrawlError(ValueError):
    """A page that answered "not modified" though nothing is stored of it."""


KINDS = {e.__name__: e for e in (SnapshotError, ChunkRefCollision, StructureError, UnitError, CrawlError)}


def _as(rows: DataFrame, kind: str, key: str, message: str) -> DataFrame:
    return rows.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.lit(message).alias("message"))


def snapshot_errors(corpus: Corpus) -> DataFrame:
    """Files that can't be read, a missing inventory, and live pages that the inventory hasn't."""
    nav = corpus.nav.select("page_ref").distinct()
    none = nav.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(corpus.root).alias("root"))
    lost = corpus.pages.where("not retired").join(nav, "page_ref", "left_anti")
    return _as(corpus.corrupt, "SnapshotError", "path", "not a page file").unionByName(_as(none, "SnapshotError", "root", "no page inventory")).unionByName(_as(lost, "SnapshotError", "page_ref", "a live page that the inventory hasn't"))


def collisions(chunks: DataFrame, ref: str = "chunk_ref") -> DataFrame:
    twice = chunks.groupBy(ref).agg(F.count(F.lit(1)).alias("n")).where(F.col(ref).isNotNull() & (F.col("n") > 1))
    return _as(twice, "ChunkRefCollision", ref, "several chunks claim this address")


def structure_errors(segmented: DataFrame, instrument: str = "instrument") -> DataFrame:
    """Of rows of ``layout.segmented``: provisions whose heading comes again below the same containers, and body text before any provision."""
    heads = segmented.where(F.col("style").isin(*PROVISION) & ~F.coalesce("in_endnotes", F.lit(False)))
    number = F.regexp_extract("text", r"^\s*([0-9]+[A-Z]*(?:\.[0-9]+[A-Z]*)*)", 1)
    # Schedules begin their numbers anew; other containers don't.
    schedule = F.get(F.filter("containers", lambda c: F.lower(c).startswith("schedule")), F.lit(0))
    keyed = heads.select(F.concat_ws("/", F.col(instrument), schedule, number).alias("key"), number.alias("number")).where("number <> ''")
    twice = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    outside = segmented.where((F.coalesce("provision_pos", F.lit(0)) == 0) & (F.size("containers") > 0) & F.col("style").isin(*[s for s in (*STYLES, *NOTES) if s], ) & ~F.col("style").isin(*CONTAINERS, *ITEM, *ENDNOTES))
    outside = outside.select(F.concat_ws("/", F.col(instrument), F.col("pos")).alias("key"))
    return _as(twice, "StructureError", "key", "a provision that is there twice").unionByName(_as(outside, "StructureError", "key", "text below a container and above its first provision"))


def unit_errors(paragraphs: DataFrame, base: str = "provision_ref") -> DataFrame:
    """The first paragraph of each unknown style of a provision; ``units.units`` raises on such."""
    known = [s for s in (*STYLES, *NOTES) if s]
    first = F.row_number().over(Window.partitionBy(base, "style").orderBy("pos"))
    rows = paragraphs.where(F.col("style").isNotNull() & ~F.col("style").isin(*known)).withColumn("_n", first).where("_n = 1")
    return rows.select(F.lit("UnitError").alias("kind"), F.col(base).cast("string").alias("key"), F.concat(F.lit("no unit has the style "), "style").alias("message"))


def crawl_errors(gated: DataFrame, key: str) -> DataFrame:
    return _as(gated.where("gate = 'failed'"), "CrawlError", key, "not modified, but nothing is stored")


def raised(errors: list[DataFrame], strict: bool = True, shown: int = 5) -> DataFrame:
    """The errors as one relation; where there are any and ``strict``, the first kind of ``KINDS`` that occurs is raised with a few keys, by one action."""
    whole = reduce(DataFrame.unionByName, errors)
    if strict:
        place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
        worst = whole.orderBy(place, "key", "message").limit(shown).collect()
        if worst:
            first = [r for r in worst if r["kind"] == worst[0]["kind"]]
            raise KINDS[worst[0]["kind"]]("; ".join(f"{r['key']}: {r['message']}" for r in first))
    return whole
