"""Snapshots on disk as DataFrames, read with fixed schemas, and the sinks that write them back."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.text import digest
from . import schemas


class SnapshotError(ValueError):
    """A snapshot that isn't one: a needed file is missing or unreadable."""


def _json(spark: SparkSession, path: str, schema: str, mode: str = "PERMISSIVE", recursive: bool = False) -> DataFrame:
    reader = spark.read.schema(schema + ", _corrupt STRING").option("multiLine", True).option("mode", mode).option("columnNameOfCorruptRecord", "_corrupt")
    return reader.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json").json(path).withColumn("path", F.col("_metadata.file_path"))


def _optional(read, spark: SparkSession, schema: str) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema + ", _corrupt STRING, path STRING")


@dataclass(frozen=True)
class Corpus:
    """A snapshot's relations. Unreadable files are rows of ``corrupt``, not an end of the run."""

    spark: SparkSession
    root: str

    @cached_property
    def files(self) -> DataFrame:
        def read(below: str) -> DataFrame:
            return _optional(lambda: _json(self.spark, f"{self.root}/{below}", schemas.PAGE_FILE, recursive=True), self.spark, schemas.PAGE_FILE)

        # Listing skips folders with a leading underscore, so the retired ones are named.
        return read("pages").withColumn("retired", F.lit(False)).unionByName(read("pages/_retired").withColumn("retired", F.lit(True)))

    @property
    def corrupt(self) -> DataFrame:
        return self.files.where("page is null or page.page_ref is null").select("path")

    @property
    def pages(self) -> DataFrame:
        return self.files.where("page.page_ref is not null").select("page.*", "retired", "path")

    @property
    def chunks(self) -> DataFrame:
        """All chunks with ``seat``, their place in their page's array."""
        rows = self.files.where("page.page_ref is not null").select(F.col("page.part_id").alias("part_id"), "retired", F.posexplode("chunks").alias("seat", "chunk"))
        return rows.select("part_id", "retired", "seat", "chunk.*")

    @property
    def provisions(self) -> DataFrame:
        read = lambda: _json(self.spark, f"{self.root}/legislation/*/provisions", schemas.PROVISION, recursive=True)
        return _optional(read, self.spark, schemas.PROVISION)

    @property
    def units(self) -> DataFrame:
        rows = self.provisions.select(F.col("ref").alias("provision"), "instrument", F.posexplode("units").alias("seat", "unit"))
        return rows.select("provision", "instrument", "seat", "unit.*")

    def _one(self, name: str, schema: str) -> DataFrame:
        return _optional(lambda: _json(self.spark, f"{self.root}/{name}", schema), self.spark, schema)

    @property
    def nav(self) -> DataFrame:
        return self._one("sitemap.json", schemas.SITEMAP).select(F.inline("pages"))

    @property
    def retired(self) -> DataFrame:
        return self._one("retired.json", schemas.RETIRED).select(F.inline("retired"))

    @property
    def instruments(self) -> DataFrame:
        return self._one("legislation/*/instrument.json", schemas.INSTRUMENT)

    @property
    def contents(self) -> DataFrame:
        return self._one("legislation/*/contents.json", schemas.CONTENTS)

    @property
    def endnotes(self) -> DataFrame:
        return self._one("legislation/*/endnotes.json", schemas.ENDNOTES).select("instrument", F.inline("endnotes"))

    @property
    def edges(self) -> DataFrame:
        """Every provision edge of a chunk."""
        return self.chunks.select("chunk_ref", "page_ref", "part_id", F.posexplode("provisions").alias("seq", "edge")).select("chunk_ref", "page_ref", "part_id", "seq", "edge.*")

    def strict(self) -> Corpus:
        """This corpus, or an error if a file can't be read or the inventory is missing."""
        if bad := self.corrupt.limit(5).collect():
            raise SnapshotError(f"not page files: {[r['path'] for r in bad]}")
        if self.nav.isEmpty():
            raise SnapshotError(f"no page inventory below {self.root}")
        return self

    def register(self, prefix: str = "") -> None:
        """Temporary views of all relations, for SQL."""
        for name in ("pages", "chunks", "provisions", "units", "nav", "retired", "instruments", "edges", "endnotes"):
            getattr(self, name).createOrReplaceTempView(prefix + name)


def read_corpus(spark: SparkSession, root: str) -> Corpus:
    return Corpus(spark, root.rstrip("/"))


def raw_html(spark: SparkSession, path: str) -> DataFrame:
    """(path, html) of raw pages."""
    return spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, content, bytes) of raw word-processor documents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(path)
    return files.select("path", "content", F.col("length").alias("bytes"))


def wrong_sizes(documents: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Downloads whose length isn't the one that the register states."""
    return documents.join(expected.select(key, F.col("bytes").alias("_stated")), key).where("bytes <> _stated")


def ordered(value: Column, kind: DataType) -> Column:
    """The value with the fields of every struct in it in alphabetical order, and its maps by key, at any depth."""
    if isinstance(kind, StructType):
        fields = [ordered(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: ordered(x, kind.elementType))
    if isinstance(kind, MapType):
        entries = F.array_sort(F.map_entries(value))
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"].alias("key"), ordered(e["value"], kind.valueType).alias("value"))))
    return value


def in_order(df: DataFrame) -> DataFrame:
    """Columns, and all within them, in alphabetical order."""
    return df.select(*[ordered(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def canonical_json(df: DataFrame, key: str) -> DataFrame:
    """(key, json, digest): each row as JSON with fields and map keys in alphabetical order at any depth, so equal content has equal bytes."""
    rows = in_order(df)
    return rows.select(F.col(key), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json")).withColumn("digest", digest(F.col("json")))


def write_changed(fresh: DataFrame, stored: DataFrame, key: str, path: str, part: str) -> DataFrame:
    """Append rows whose digest isn't the stored one, partitioned; returns them."""
    held = stored.select(F.col(key).alias("_key"), F.col("digest").alias("_digest"))
    moved = fresh.join(held, (F.col(key) == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left_anti")
    moved.write.mode("append").partitionBy(part).parquet(path)
    return moved


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """A flat export in one ordered file: for reports, whose size people read."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
