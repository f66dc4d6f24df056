"""The page inventory of a nav tree, and the settling of internal references against the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_url, path_prefixes, slug
from .relations import duplicates, strongest

PART = r"^\s*Part\s+([0-9]+[A-Za-z]?)\b"


def inventory(entries: DataFrame, prefix: str, base: str = "", site: str = "nav") -> DataFrame:
    """Nav entries (site, pos, depth, title, href) as pages: part carried forward, address, kind, ordinal within the part.

    A part's own entry is its landing page; an entry numbered below its part has that number as address, others their slug.
    """
    w = Window.partitionBy(site).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    number = F.regexp_extract("title", PART, 1)
    part = F.last(F.when(number != "", F.struct(number.alias("number"), F.col("title").alias("title"))), ignorenulls=True).over(w)
    rows = entries.withColumn("_part", part).withColumn("_landing", number != "")
    rest = F.regexp_extract("title", r"^\s*([0-9]+[A-Za-z]?(?:\.[0-9]+)+)", 1)
    below = F.when(F.startswith(rest, F.concat(F.col("_part.number"), F.lit("."))), F.replace(F.substring(rest, F.length("_part.number") + F.lit(2), F.length(rest)), F.lit("."), F.lit("/")))
    tail = F.when(F.col("_landing"), F.lit("")).otherwise(F.coalesce(below, slug(F.col("title"))))
    ref = F.concat_ws("/", F.lit(prefix), F.concat(F.lit("Part"), "_part.number"), F.nullif(tail, F.lit("")))
    kind = F.when(F.col("_landing"), "landing").when(F.lower("title").rlike("annex"), "annex").otherwise("body")
    named = rows.select(site, "pos", canonical_url(F.col("href"), base).alias("url"), ref.alias("page_ref"), F.concat(F.lit("Part"), "_part.number").alias("part_id"), F.col("_part.title").alias("part_title"), F.col("title").alias("nav_title"), kind.alias("kind"))
    return named.withColumn("nav_ordinal", F.row_number().over(Window.partitionBy(site, "part_id").orderBy("pos")))


def inventory_problems(pages: DataFrame) -> DataFrame:
    """(check, where, message): entries without a part, addresses and urls that come up twice."""
    lost = pages.where("part_id is null").select(F.lit("part").alias("check"), F.col("nav_title").alias("where"), F.lit("no part above this entry").alias("message"))
    twice = [duplicates(pages, key).select(F.lit(key).alias("check"), F.col(key).alias("where"), F.concat(F.lit("comes up "), "n", F.lit(" times")).alias("message")) for key in ("page_ref", "url")]
    return lost.unionByName(twice[0]).unionByName(twice[1])


def anchor_ref(page_ref: Column, href: Column) -> Column:
    """The chunk that a link's fragment asks for: the number that a heading's slug begins with as a path, other words as their slug."""
    fragment = F.regexp_extract(href, "#(.*)$", 1)
    number = F.regexp_extract(fragment, r"^_?([0-9]{1,3}[A-Z]?(?:\.[0-9]+)*)(?=-|$)", 1)
    tail = F.when(number != "", F.replace(number, F.lit("."), F.lit("/"))).otherwise(slug(fragment))
    return F.when(tail == "", page_ref).otherwise(F.concat_ws("/", page_ref, tail))


def link_candidates(links: DataFrame, pages: DataFrame, key: str, base: str = "") -> DataFrame:
    """(key, ref, extraction, mention, seq) of links (key, href, words, seq) that lead to pages of the inventory."""
    known = pages.select(F.col("url").alias("_url"), "page_ref").dropDuplicates(["_url"])
    met = links.withColumn("_url", canonical_url(F.col("href"), base)).join(known, "_url")
    return met.select(key, anchor_ref(F.col("page_ref"), F.col("href")).alias("ref"), F.lit("href").alias("extraction"), F.col("words").alias("mention"), "seq")


def settled(candidates: DataFrame, chunk_refs: DataFrame, page_refs: DataFrame, key: str) -> DataFrame:
    """Candidates settled against every chunk and page: exact, else the first fragment, else the nearest page above, else dropped.

    Of several that settle on one target the strongest stays. Settling again changes nothing.
    """
    exact = chunk_refs.select(F.col("ref").alias("_e")).unionByName(page_refs.select(F.col("ref").alias("_e"))).distinct()
    first = chunk_refs.where("ref like '%~1'").select(F.expr("left(ref, length(ref) - 2)").alias("_f"), F.col("ref").alias("_first")).distinct()
    wanted = candidates.select("ref").distinct()
    above = wanted.select("ref", F.posexplode(path_prefixes(F.col("ref"))).alias("_far", "_up")).join(page_refs.select(F.col("ref").alias("_up")).distinct(), "_up")
    # A part alone is no page to fall back on: an address needs two segments below its prefix.
    above = above.where("size(split(_up, '/')) >= 3").groupBy("ref").agg(F.min_by("_up", "_far").alias("_page"))
    targets = wanted.join(exact, F.col("ref") == F.col("_e"), "left").join(first, F.col("ref") == F.col("_f"), "left").join(above, "ref", "left")
    targets = targets.select("ref", F.coalesce("_e", "_first", "_page").alias("_target")).where("_target is not null")
    rows = candidates.join(targets, "ref").drop("ref").withColumnRenamed("_target", "ref")
    return strongest(rows, [key, "ref"], F.when(F.col("extraction") == "href", 0).otherwise(1), ["seq"])
