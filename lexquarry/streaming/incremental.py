"""Incremental runs: landed fetch results are gated, merged and retired batch by batch.

Correctness is that of the batch functions in ``operators.changes``; the stream only feeds them. State is a
versioned table in a shared folder: each batch writes the next version whole and is repeatable by its id, so a batch
tried again after a lost driver gives the same version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.changes import merged, retired
from ..sources.schemas import FETCHED

STATE = "url STRING, digest STRING, html STRING, first_seen STRING"


def state(spark: SparkSession, folder: str, batch: int) -> DataFrame:
    """The state before a batch: the newest version under its id, or none."""
    try:
        versions = spark.read.schema("version LONG").option("basePath", folder).parquet(f"{folder}/version=*")
        newest = versions.where(F.col("version") < batch).agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    return spark.createDataFrame([], STATE) if newest is None else spark.read.schema(STATE).parquet(f"{folder}/version={newest}")


def usable(fetched: DataFrame) -> DataFrame:
    """The last good answer of each url in a batch, by its HTTP date; a 304 brings nothing new, other statuses are unreachable."""
    good = fetched.where("status = 200 and html is not null")
    stamp = F.regexp_replace("last_modified", "^[A-Za-z]+, ", "")
    when = F.coalesce(F.try_to_timestamp(stamp, F.lit("dd MMM yyyy HH:mm:ss 'GMT'")), F.try_to_timestamp(stamp), F.lit(0).cast("timestamp"))
    return good.groupBy("url").agg(F.max_by("html", F.struct(when, "html")).alias("html")).withColumn("digest", F.sha2("html", 256))


def unreachable(fetched: DataFrame) -> DataFrame:
    return fetched.where("status not in (200, 304)").select("url", "status").distinct()


def step(folder: str, now: Callable[[int], str], parse: Callable[[DataFrame], None] | None = None) -> Callable[[DataFrame, int], None]:
    """The function of a batch: merge its pages into the state, and hand those that moved to ``parse``."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before, fresh = state(spark, folder, number), usable(batch)
        if parse:
            held = before.select(F.col("url").alias("_url"), F.col("digest").alias("_digest"))
            parse(fresh.join(held, (F.col("url") == F.col("_url")) & (F.col("digest") == F.col("_digest")), "left_anti"))
        after = merged(before, fresh.withColumn("first_seen", F.lit(now(number))), "url", ["digest"], "first_seen", now(number))
        after.select("url", "digest", "html", "first_seen").write.mode("overwrite").parquet(f"{folder}/version={number}")

    return run


def follow(spark: SparkSession, landed: str, folder: str, checkpoint: str, now: Callable[[int], str], parse: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Start following a folder of landed fetch results; handles what is there and stops."""
    stream = spark.readStream.schema(FETCHED).json(landed)
    return stream.writeStream.foreachBatch(step(folder, now, parse)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def concluded(stored: DataFrame, inventory: DataFrame, already: DataFrame, now: str, complete: bool) -> DataFrame:
    """The retirement index after a run; a partial run concludes nothing."""
    return retired(stored, inventory, "url", already, now) if complete else already
