"""Writers of a snapshot's documents: pages with their chunks, sources, manifests; amendments in one shape.

One file a document is the snapshot's format; files go out from the executors, a folder by part, and read back with
``snapshot.read_corpus``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from . import schemas
from .snapshot import _optional, in_order, ordered


def with_sorted_edges(chunks: DataFrame) -> DataFrame:
    """Chunks whose provisions and cases are in one order, missing fields first as if empty, so equal content has equal bytes."""
    text = lambda c: F.coalesce(c, F.lit(""))

    def sort(name: str, *fields: str) -> Column:
        keyed = F.transform(name, lambda x: F.struct(*[text(x[f]).alias(f"k{i}") for i, f in enumerate(fields)], x.alias("item")))
        return F.transform(F.array_sort(keyed), lambda x: x["item"])

    return chunks.withColumn("provisions", sort("provisions", "id", "extraction", "certainty", "mention")).withColumn("cases", sort("cases", "id", "citation"))


def page_documents(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """(part_id, page, chunks): each page with its chunks by ordinal; a page without any has an empty array."""
    rows = with_sorted_edges(chunks)
    kept = [c for c in rows.columns if c not in ("part_id", "retired", "seat")]
    lists = rows.groupBy(F.col("page_ref").alias("_page")).agg(F.array_sort(F.collect_list(F.struct("ordinal", F.struct(*kept).alias("chunk")))).alias("_held"))
    fields = [c for c in pages.columns if c not in ("retired", "path")]
    met = pages.select(F.col("part_id").alias("_part"), F.col("page_ref").alias("_ref"), F.struct(*fields).alias("page")).join(lists, F.col("_ref") == F.col("_page"), "left")
    empty = F.array().cast(ArrayType(rows.select(F.struct(*kept).alias("x")).schema["x"].dataType))
    return met.select(F.col("_part").alias("part_id"), "page", F.coalesce(F.transform("_held", lambda x: x["chunk"]), empty).alias("chunks"))


def write_documents(documents: DataFrame, path: str, part: str | None = None) -> None:
    """One JSON file a row, in folders by ``part``, fields in order and nulls written.

    By part, only the folders of the parts given are replaced, so a run over one part leaves the others; else the whole folder.
    """
    body = in_order(documents.drop(part) if part else documents)
    rows = body if part is None else documents.select(F.col(part), *[ordered(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in body.schema.fields])
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", 1).option("ignoreNullFields", "false").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(part) if part else writer).json(path)


def write_sources(sources: DataFrame, key: str, html: str, path: str) -> None:
    """Raw pages as Parquet, sorted by address within each file: whole bytes, and a single page is read by its address."""
    sources.select(key, F.to_binary(F.col(html), F.lit("utf-8")).alias("content")).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def read_sources(spark: SparkSession, path: str, key: str) -> DataFrame:
    return spark.read.parquet(path).select(key, F.decode("content", "utf-8").alias("html"))


def manifest(corpus: DataFrame, counters: DataFrame, unreachable: DataFrame, version: str, started: str, finished: str) -> DataFrame:
    """The one row that tells of a run: sizes of the corpus, counters, and the pages that couldn't be reached."""
    failed = unreachable.agg(F.array_sort(F.collect_list(F.struct("page_ref", "url", "status"))).alias("unreachable")).scalar()
    run = F.struct(*[counters.select(c).scalar().alias(c) for c in counters.columns], failed.alias("unreachable"))
    return corpus.select(F.lit(started).alias("crawled_at"), F.lit(finished).alias("finished_at"), F.lit(version).alias("extractor_version"), F.struct("*").alias("corpus"), run.alias("run"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as one row, or no row where there is none."""
    return _optional(lambda: spark.read.schema(schemas.MANIFEST + ", _corrupt STRING").option("multiLine", True).json(path).withColumn("path", F.col("_metadata.file_path")), spark, schemas.MANIFEST).drop("_corrupt", "path")


def flat_amendments(reasons: Column) -> Column:
    """Reasons of a version in one shape, in the order of their JSON: the affected title if it has an id, else the amending one."""

    def flat(r: Column) -> Column:
        of = F.when(r["affectedByTitle"]["titleId"] != "", r["affectedByTitle"]).when(r["amendedByTitle"]["titleId"] != "", r["amendedByTitle"])
        fields = {"affect": r["affect"], "markdown": r["markdown"], "name": of["name"], "number": of["number"], "provisions": of["provisions"], "series_type": of["seriesType"], "title_id": of["titleId"], "year": of["year"]}
        return F.struct(*[c.alias(n) for n, c in fields.items()])

    rows = F.transform(F.filter(reasons, lambda r: r.isNotNull()), flat)
    keyed = F.transform(rows, lambda r: F.struct(F.to_json(r, {"ignoreNullFields": "false"}).alias("json"), r.alias("row")))
    return F.transform(F.array_sort(keyed), lambda x: x["row"])
