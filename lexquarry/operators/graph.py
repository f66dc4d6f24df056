"""Citation graph: weighted edges between groups, nodes with measures, visible subgraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rolled_up(citations: DataFrame, source: str, target: str, citing: str, ref: str) -> DataFrame:
    """(source, target, weight) between groups: distinct (reference, citing item) pairs, none within a group."""
    pairs = citations.where(F.col(source).isNotNull() & F.col(target).isNotNull() & (F.col(source) != F.col(target))).select(F.col(source).alias("source"), F.col(target).alias("target"), F.col(citing).alias("_c"), F.col(ref).alias("_r")).distinct()
    return pairs.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def nodes(edges: DataFrame) -> DataFrame:
    """(id, degree, edge_count, heaviest): both ends of every edge."""
    ends = edges.select(F.col("source").alias("id"), "weight").unionByName(edges.select(F.col("target").alias("id"), "weight"))
    return ends.groupBy("id").agg(F.sum("weight").alias("degree"), F.count(F.lit(1)).alias("edge_count"), F.max("weight").alias("heaviest"))


def visible(edges: DataFrame, kinds: list[str], least: int | Column, weighted: list[str], allowed: DataFrame | None = None) -> DataFrame:
    """Edges of the kinds, of at least the weight where a kind is weighted, both ends among ``allowed`` (id)."""
    shown = edges.where(F.col("kind").isin(kinds) & (~F.col("kind").isin(weighted) | (F.col("weight") >= least)))
    if allowed is not None:
        for end in ("source", "target"):
            shown = shown.join(allowed.select(F.col("id").alias(end)), end, "left_semi")
    return shown


def neighbours(edges: DataFrame, node: str) -> DataFrame:
    """(id, direction, kind, weight) of the edges at one node."""
    out = edges.where(F.col("source") == node).select(F.col("target").alias("id"), F.lit("out").alias("direction"), "kind", "weight")
    return out.unionByName(edges.where(F.col("target") == node).select(F.col("source").alias("id"), F.lit("in").alias("direction"), "kind", "weight"))
