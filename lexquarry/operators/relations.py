"""Relational operators of a document corpus: facets, indexes, resolution, hierarchy, windows.

Each takes DataFrames whose column names are parameters and returns a DataFrame; nothing is
collected. Joins leave the side to broadcast to the optimiser, which knows sizes at run time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import path_prefixes
from ..sources.publish import stage


def facet_values(df: DataFrame, facets: dict[str, Column], missing: str = "none") -> DataFrame:
    """(facet, value) of all facets of each row in one pass; an array gives each of its items, a null counts under ``missing`` but a null array not at all."""

    def pairs(name: str, value: Column) -> Column:
        one = lambda v: F.struct(F.lit(name).alias("facet"), F.coalesce(v.cast("string"), F.lit(missing)).alias("value"))
        return F.coalesce(F.transform(value, one), F.array().cast("array<struct<facet:string,value:string>>"))

    kinds = df.select(*[c.alias(n) for n, c in facets.items()]).schema
    lists = [pairs(n, c if kinds[n].dataType.typeName() == "array" else F.array(c)) for n, c in facets.items()]
    return df.select(F.inline(F.concat(*lists)))


def in_ranks(counts: DataFrame) -> DataFrame:
    """(facet, value, n, rank) of counts (facet, value, n): by count, then value.

    Counts are dealt by ranges of that order and written; each range numbers its own, after as many as the ranges before hold of the facet.
    So no task sorts a whole facet, whatever its values.
    """
    order = [F.desc("n"), F.col("value")]
    dealt = stage(counts.repartitionByRange("facet", *order).withColumn("_range", F.spark_partition_id()))
    held = dealt.groupBy("facet", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("facet").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy("facet", "_range").orderBy(*order))
    return dealt.withColumn("_own", own).join(held.select("facet", "_range", before.alias("_before")), ["facet", "_range"]).select("facet", "value", "n", (F.col("_own") + F.col("_before")).cast("long").alias("rank"))


def counted(values: DataFrame) -> DataFrame:
    return values.groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def facet_counts(df: DataFrame, facet: Column | str, value: Column | str, missing: str = "none") -> DataFrame:
    """(facet, value, n); a null counts under ``missing``."""
    facet, value = (x if isinstance(x, Column) else F.col(x) for x in (facet, value))
    return counted(df.select(facet.cast("string").alias("facet"), F.coalesce(value.cast("string"), F.lit(missing)).alias("value")))


def ranked(df: DataFrame, facet: Column | str, value: Column | str, missing: str = "none") -> DataFrame:
    """(facet, value, n, rank) in order of count, then value."""
    return in_ranks(facet_counts(df, facet, value, missing))


def merged_facets(*facets: DataFrame) -> DataFrame:
    """Counts of several corpora summed."""
    whole = reduce(DataFrame.unionByName, [f.select("facet", "value", "n") for f in facets])
    return whole.groupBy("facet", "value").agg(F.sum("n").alias("n"))


def reverse_index(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(target, sources, n): the distinct sorted sources of each target, self-references dropped.

    Distinct pairs are made first, so a hot target is combined map-side before its list is built.
    """
    pairs = edges.where(~F.col(source).cast("string").eqNullSafe(F.col(target).cast("string"))).select(F.col(target).alias("target"), F.col(source).cast("string").alias("source")).distinct()
    return pairs.groupBy("target").agg(F.array_join(F.array_sort(F.collect_list("source")), ",").alias("sources"), F.count("source").alias("n"))


def strongest(edges: DataFrame, key: list[str], rank: Column, seq: list[str]) -> DataFrame:
    """Of the edges of a key, that of least rank, the first offered on ties; partial aggregation, no sort."""
    rest = [c for c in edges.columns if c not in key]
    best = edges.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(rank.alias("_rank"), *seq)).alias("_best"))
    return best.select(*key, *[F.col("_best")[c].alias(c) for c in rest])


def resolved(edges: DataFrame, ref: str, firsts: DataFrame, seconds: DataFrame) -> DataFrame:
    """Two-step resolution: ``ref`` is itself an owner, or a unit whose owner is known, or nothing.

    ``firsts`` has (ref); ``seconds`` has (ref, owner). Adds ``owner``.
    """
    a = firsts.select(F.col("ref").alias("_a")).distinct()
    b = seconds.groupBy(F.col("ref").alias("_b")).agg(F.max("owner").alias("_owner"))
    return edges.join(a, F.col(ref) == F.col("_a"), "left").join(b, F.col(ref) == F.col("_b"), "left").withColumn("owner", F.coalesce("_a", "_owner")).drop("_a", "_b", "_owner")


def join_report(edges: DataFrame, ref: str, owner: str = "owner") -> DataFrame:
    """One row: edges, those resolved, and the distinct references that aren't."""
    return edges.agg(
        F.count(F.lit(1)).alias("edges"), F.count_if(F.col(owner).isNotNull()).alias("resolved"),
        F.countDistinct(F.when(F.col(owner).isNull(), F.col(ref))).alias("unresolved_refs"),
    )


def nearest_ancestor(refs: DataFrame, path: str, group: list[str], known: DataFrame, known_path: str) -> DataFrame:
    """Adds ``ancestor``: the longest proper prefix of ``path`` that ``known`` has in the same group."""
    probes = refs.select(*group, path).distinct().select(*group, path, F.posexplode(path_prefixes(F.col(path))).alias("_far", "_prefix"))
    held = known.select(*group, F.col(known_path).alias("_prefix")).distinct()
    found = probes.join(held, [*group, "_prefix"]).groupBy(*group, path).agg(F.min_by("_prefix", "_far").alias("ancestor"))
    return refs.join(found, [*group, path], "left")


def missing(left: DataFrame, key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` hasn't."""
    keys = right.select(F.col(right_key).alias("_key"))
    return left.join(keys, F.col(key) == F.col("_key"), "left_anti")


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that come up more than once, with their number."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def starts(blocks: DataFrame, group: str, seq: str, text: str) -> DataFrame:
    """Adds ``start``: the offset of each block in the text of its group joined by single characters."""
    before = Window.partitionBy(group).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("start", F.coalesce(F.sum(F.length(text) + 1).over(before), F.lit(0)).cast("long"))


def siblings(df: DataFrame, group: str, seq: str, value: str) -> DataFrame:
    """Adds ``previous`` and ``following``."""
    w = Window.partitionBy(group).orderBy(seq)
    return df.withColumns({"previous": F.lag(value).over(w), "following": F.lead(value).over(w)})


def carried(df: DataFrame, group: str, seq: str, value: Column, name: str) -> DataFrame:
    """Adds the last non-null value up to and with each row."""
    w = Window.partitionBy(group).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def packed(lengths: Column, limit: int) -> Column:
    """Greedy packing of block lengths into groups of at most ``limit`` characters, one between blocks: group sizes."""
    start = F.struct(F.lit(0).cast("long").alias("now"), F.lit(0).cast("long").alias("groups"), F.lit(0).cast("long").alias("largest"))

    def step(acc: Column, n: Column) -> Column:
        fits = (acc["now"] > 0) & (acc["now"] + 1 + n <= limit)
        now = F.when(fits, acc["now"] + 1 + n).otherwise(n.cast("long"))
        return F.struct(now.alias("now"), F.when(fits, acc["groups"]).otherwise(acc["groups"] + 1).alias("groups"), F.greatest(acc["largest"], now).alias("largest"))

    return F.aggregate(lengths, start, step)


def top_with_rest(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group with ``more``, the number left out; group limits are pushed into the window."""
    w = Window.partitionBy(group).orderBy(*order)
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    first = df.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
    return first.join(sizes, group).withColumn("more", F.greatest(F.col("_n") - k, F.lit(0)).cast("long")).drop("_n")


def descendants(edges: DataFrame, parent: str, child: str, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(ancestor, node, depth) of an adjacency list of any depth; depth is that of the shortest way. In a cycle each node is below itself, too.

    Each round joins the pairs of the greatest depth so far to all pairs, so reach doubles and rounds are few even for long chains; pairs that
    are there already end the walk of a cycle. ``stage`` writes a table and reads it back (lineage would double, too).
    """
    step = edges.where(F.col(parent).isNotNull() & F.col(child).isNotNull()).select(F.col(parent).alias("ancestor"), F.col(child).alias("node")).distinct()
    found, reach = stage(step.withColumn("depth", F.lit(1))), 1
    while True:
        front = found.where(F.col("depth") == reach).select("ancestor", F.col("node").alias("_via"), F.col("depth").alias("_far"))
        below = found.select(F.col("ancestor").alias("_via"), "node", "depth")
        longer = front.join(below, "_via").groupBy("ancestor", "node").agg(F.min(F.col("_far") + F.col("depth")).alias("depth"))
        new = stage(longer.join(found.select("ancestor", "node"), ["ancestor", "node"], "left_anti"))
        if new.isEmpty():
            return found
        found, reach = stage(found.unionByName(new)), 2 * reach


def counted_above(pairs: DataFrame, items: DataFrame, node: str, item: str) -> DataFrame:
    """(ancestor, n): distinct items of each node and of all below it; an item at several places below one ancestor counts once there."""
    own = items.select(F.col(node).alias("ancestor"), item)
    up = items.select(F.col(node).alias("node"), item).join(pairs.select("ancestor", "node"), "node").select("ancestor", item)
    return own.unionByName(up).groupBy("ancestor").agg(F.countDistinct(item).alias("n"))
