"""The corpus pipeline: toxicity, near-duplicates, benchmark leaks, personal data, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``. Decisions take effect: toxic documents go, one document of each group of near-duplicates
stays, documents that hold a benchmark item go, personal data is replaced by its kind, and the
last stage returns the ids of the text's pieces with the digests of ids and decoded text.

Texts reach Python ``BATCH_BYTES`` at a time (a longer text alone), whatever the number of rows, so a task's memory doesn't grow with the
length of its texts.

Edge cases, stage by stage as its operator's docstring says: null and empty texts are clean, are linked with nothing, leak nothing and have no pieces; rows of a null doc_id
stay; repeated rows are judged each, and near-duplicates keep one of a group; extra columns are carried to the last stage; empty tables give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lexquarry.llm import decontaminate, neardup, pieces, pii, shared, toxicity


BATCH_BYTES = 4 << 20


def bounded(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, for the stages whose plans run Python."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark)
    return pieces.encode_decode(docs, public_tokenizers.path(pieces.MODEL), texts=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("pieces", pieces_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None
