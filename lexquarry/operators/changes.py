"""Comparison of two snapshots, gates for unchanged records, merge and retirement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compared(before: DataFrame, after: DataFrame, key: str, body: str, fields: list[str]) -> DataFrame:
    """One row a key: status and moved fields.

    Status is added, vanished, amended (the body moved), reworded (only fields moved) or
    unchanged. Both sides have ``key``, ``body`` and ``fields``; comparisons are null-safe.
    """
    b, a = before.alias("b"), after.alias("a")
    both = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "full_outer")
    moved = F.filter(F.array(*[F.when(~F.col(f"b.{f}").eqNullSafe(F.col(f"a.{f}")), F.lit(f)) for f in sorted(fields)]), lambda x: x.isNotNull())
    status = (
        F.when(F.col(f"b.{key}").isNull(), "added")
        .when(F.col(f"a.{key}").isNull(), "vanished")
        .when(~F.col(f"b.{body}").eqNullSafe(F.col(f"a.{body}")), "amended")
        .when(F.size(moved) > 0, "reworded")
        .otherwise("unchanged")
    )
    fields_moved = F.when(status.isin("amended", "reworded"), F.array_join(moved, ",")).otherwise("")
    return both.select(F.coalesce(f"b.{key}", f"a.{key}").alias(key), status.alias("status"), fields_moved.alias("moved"))


def with_retirement(changes: DataFrame, retired_before: DataFrame, retired_after: DataFrame, key: str) -> DataFrame:
    """Added keys that were retired before are restored, vanished ones that now are retired are retired."""
    was, now = (r.select(F.col(key).alias(n)).distinct() for r, n in ((retired_before, "_was"), (retired_after, "_now")))
    joined = changes.join(was, F.col(key) == F.col("_was"), "left").join(now, F.col(key) == F.col("_now"), "left")
    status = F.when((F.col("status") == "added") & F.col("_was").isNotNull(), "restored").when((F.col("status") == "vanished") & F.col("_now").isNotNull(), "retired").otherwise(F.col("status"))
    return joined.withColumn("status", status).drop("_was", "_now")


def part_changes(before: DataFrame, after: DataFrame, group: str, item: str, body: str) -> DataFrame:
    """Per group: how many items were edited, added, removed, and how many there are now."""
    b, a = before.select(group, item, F.col(body).alias("_b"), F.lit(True).alias("_in_b")), after.select(group, item, F.col(body).alias("_a"), F.lit(True).alias("_in_a"))
    both = b.join(a, [group, item], "full_outer")
    return both.groupBy(group).agg(
        F.count_if(F.col("_in_b") & F.col("_in_a") & ~F.col("_b").eqNullSafe(F.col("_a"))).alias("edited"),
        F.count_if(F.col("_in_b").isNull()).alias("added"), F.count_if(F.col("_in_a").isNull()).alias("removed"), F.count_if(F.col("_in_a")).alias("total"),
    )


def gated(stored: DataFrame, fresh: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``fresh`` with ``gate``: new, skip (every field equal, null-safe) or write."""
    s = stored.select(F.col(key).alias("_key"), F.struct(*fields).alias("_stored"))
    joined = fresh.join(s, F.col(key) == F.col("_key"), "left")
    return joined.withColumn("gate", F.when(F.col("_key").isNull(), "new").when(F.struct(*fields).eqNullSafe(F.col("_stored")), "skip").otherwise("write")).drop("_key", "_stored")


def merged(stored: DataFrame, fresh: DataFrame, key: str, content: list[str], stamp: str, now: str) -> DataFrame:
    """The new state: fresh rows, their stamp carried where content is equal, and stored rows not seen."""
    s = stored.select(F.col(key).alias("_key"), F.struct(*content).alias("_content"), F.col(stamp).alias("_stamp"))
    joined = fresh.drop(stamp).join(s, F.col(key) == F.col("_key"), "left")
    kept = joined.withColumn(stamp, F.when(F.struct(*content).eqNullSafe(F.col("_content")), F.col("_stamp")).otherwise(F.lit(now))).drop("_key", "_content", "_stamp")
    unseen = stored.join(fresh.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_anti")
    return kept.unionByName(unseen.select(*kept.columns))


def retired(stored: DataFrame, inventory: DataFrame, key: str, already: DataFrame, now: str) -> DataFrame:
    """The retirement index: stored keys not in the inventory, and earlier ones that haven't come back."""
    live = inventory.select(F.col(key).alias("_key")).distinct()
    gone = stored.join(live, F.col(key) == F.col("_key"), "left_anti").select(key).distinct().withColumn("retired_at", F.lit(now))
    earlier = already.join(live, F.col(key) == F.col("_key"), "left_anti").select(key, "retired_at")
    return earlier.unionByName(gone).groupBy(key).agg(F.min("retired_at").alias("retired_at"))
