"""Viewer relations of a corpus: facets, indexes, the join of both corpora, the graph and the case export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.snapshot import Corpus
from . import export, graph
from .relations import counted, facet_values, in_ranks, join_report, resolved, reverse_index


def facets(corpus: Corpus) -> DataFrame:
    """(facet, value, n, rank): per edge, per chunk and per page counts, the missing under ``none``; chunks are read once for all of theirs."""
    edge = lambda field: F.transform("provisions", lambda p: p[field])
    of_chunks = {
        "instrument": F.transform("provisions", lambda p: F.substring_index(p["id"], "/", 1)), "provision": edge("id"), "extraction": edge("extraction"), "certainty": edge("certainty"),
        "kind": F.col("kind"), "heading_source": F.col("heading_source"), "case": F.transform("cases", lambda c: c["id"]),
    }
    years = corpus.pages.where("last_amended is not null").select(F.substring("last_amended", 1, 4).alias("year"))
    return in_ranks(counted(facet_values(corpus.chunks, of_chunks).unionByName(facet_values(years, {"year": F.col("year")}))))


def parts(corpus: Corpus) -> DataFrame:
    """(part_id, title, pages, chunks): parts of the inventory and those that only retired pages have."""
    titles = corpus.nav.groupBy("part_id").agg(F.max_by("part_title", "page_ref").alias("title"))
    pages = corpus.pages.groupBy("part_id").agg(F.count(F.lit(1)).alias("pages"))
    chunks = corpus.chunks.groupBy("part_id").agg(F.count(F.lit(1)).alias("chunks"))
    joined = titles.join(pages, "part_id", "full_outer").join(chunks, "part_id", "full_outer")
    return joined.select("part_id", F.coalesce("title", "part_id").alias("title"), F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("chunks", F.lit(0)).alias("chunks"))


def cited_by(corpus: Corpus) -> DataFrame:
    refs = corpus.chunks.select("chunk_ref", F.explode("internal_refs.ref").alias("ref"))
    return reverse_index(refs, "chunk_ref", "ref")


def cross_references(corpus: Corpus) -> DataFrame:
    """Edges of passages in the scope of the instruments present, with the provision that owns each."""
    present = corpus.provisions.select(F.col("instrument").alias("_code")).distinct()
    edges = corpus.edges.join(present, F.substring_index("id", "/", 1) == F.col("_code"), "left_semi")
    seconds = corpus.units.select("ref", F.col("provision").alias("owner"))
    return resolved(edges, "id", corpus.provisions.select("ref"), seconds)


def cross_report(corpus: Corpus) -> DataFrame:
    return join_report(cross_references(corpus), "id")


def law_edges(corpus: Corpus) -> DataFrame:
    """(source, target) between provisions, by way of their units; none to itself."""
    edges = corpus.units.where("provisions is not null").select("provision", F.explode("provisions.id").alias("id"))
    owned = resolved(edges, "id", corpus.provisions.select("ref"), corpus.units.select("ref", F.col("provision").alias("owner")))
    return owned.where("owner is not null and owner <> provision").select(F.col("provision").alias("source"), F.col("owner").alias("target")).distinct()


def citation_graph(corpus: Corpus) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): parts, and the provisions that an edge touches; references within a part and unplaceable ones don't count."""
    place = corpus.chunks.select(F.col("chunk_ref").alias("ref"), "part_id").unionByName(corpus.pages.select(F.col("page_ref").alias("ref"), "part_id")).dropDuplicates(["ref"])
    inner = corpus.chunks.select("chunk_ref", F.col("part_id").alias("source"), F.explode("internal_refs.ref").alias("ref")).join(place.withColumnRenamed("part_id", "target"), "ref")
    manual = graph.rolled_up(inner, "source", "target", "chunk_ref", "ref").withColumn("kind", F.lit("manual_to_manual"))
    law = cross_references(corpus).where("owner is not null").groupBy(F.col("part_id").alias("source"), F.col("owner").alias("target")).agg(F.countDistinct("chunk_ref").alias("weight")).withColumn("kind", F.lit("manual_to_law"))
    between = law_edges(corpus).withColumn("weight", F.lit(1).cast("long")).withColumn("kind", F.lit("law_to_law"))
    edges = manual.unionByName(law).unionByName(between)
    nodes = parts(corpus).select(F.col("part_id").alias("id"), F.lit("part").alias("kind")).unionByName(graph.nodes(edges).join(corpus.provisions.select(F.col("ref").alias("id")), "id", "left_semi").select("id", F.lit("provision").alias("kind")))
    return nodes.join(graph.nodes(edges), "id", "left").select("id", "kind", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("edge_count", F.lit(0)).alias("edge_count")), edges


def case_rows(corpus: Corpus, strict: bool = True) -> DataFrame:
    """The flat case export: one row a decision of a passage, in the columns of ``export.COLUMNS``; passages of retired pages count too."""
    return export.positions(corpus.chunks, corpus.pages, strict)
