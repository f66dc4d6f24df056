"""Published versions of several tables at once, and files that are written only where their content moved.

A store is a folder with ``tables/<run>/<table>-<trial>`` (Parquet) and ``commits`` (one JSON row a commit). Tables are written aside first, the commit
row last and by one rename, so a run that ends anywhere before leaves the version before, and can be tried again under its name. A table whose
rows are the stored ones isn't published again; a run that moves none leaves no commit. Rows are counted and their digest is taken by the write
itself, without a second pass. Large tables keyed by an address grow by deltas: only rows that moved are written, and newer deltas hide older
rows of their keys. One writer at a time; of two that publish at once the second fails.
"""

from __future__ import annotations

import json
import posixpath
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMIT = "seq LONG, run STRING, at STRING, tables STRING"
WRITTEN = "key string, file string, digest string"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that driver and executors share (``spark.checkpoint.dir``); a temporary one only in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lexquarry-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lexquarry/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, and lost executors cost no more than a stage."""
    path = shared_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Store:
    """Versions of tables below ``root``; a table's rows are those of the newest commit."""

    spark: SparkSession
    root: str

    def commits(self) -> list[dict]:
        """All commits, oldest first: as many as runs that moved something."""
        try:
            rows = self.spark.read.schema(COMMIT).option("recursiveFileLookup", True).json(f"{self.root}/commits").where("seq is not null").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [r.asDict() | {"tables": json.loads(r["tables"])} for r in sorted(rows, key=lambda r: r["seq"])]

    def table(self, name: str, schema: str, commit: dict | None = None) -> DataFrame:
        """The rows of a table in the newest commit (or the one given); none where it was never published."""
        commit = commit or next(reversed(self.commits()), None)
        held = commit["tables"].get(name) if commit else None
        if not held:
            return self.spark.range(0).where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)])
        deltas = [self.spark.read.schema(schema).parquet(x) for x in held["paths"]]
        if not held["key"]:
            return deltas[0]
        shown = [d.join(reduce(DataFrame.unionByName, [n.select(held["key"]) for n in deltas[i + 1 :]]), held["key"], "left_anti") if i + 1 < len(deltas) else d for i, d in enumerate(deltas)]
        return reduce(DataFrame.unionByName, shown)

    def aside(self, df: DataFrame, run: str, name: str) -> DataFrame:
        """``df`` written beside a run's tables and read back, for steps that use it more than once; a sweep removes it."""
        path = f"{self.root}/tables/{run}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _written(self, df: DataFrame, path: str) -> dict:
        """Writes ``df`` and tells its number of rows and an order-free digest of them, observed by the write."""
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        total = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")
        df.observe(seen, F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b")).write.mode("overwrite").parquet(path)
        return seen.get

    def publish(self, run: str, at: str, whole: dict[str, DataFrame], deltas: dict[str, tuple[DataFrame, str]] | None = None, most: int = 8) -> dict[str, int]:
        """Publishes whole tables and deltas (rows that moved, and their key) under one commit; returns the rows written of each table that moved.

        A run that is already committed does nothing. A table of more than ``most`` deltas is put together again.
        """
        commits = self.commits()
        if any(c["run"] == run for c in commits):
            return {}
        tables, moved = dict(commits[-1]["tables"]) if commits else {}, {}
        for name, df in whole.items():
            path = f"{self.root}/tables/{run}/{name}-{uuid.uuid4().hex}"
            told = self._written(df, path)
            if name not in tables or tables[name]["told"] != told:
                tables[name], moved[name] = {"paths": [path], "key": None, "told": told}, told["n"]
        for name, (df, key) in (deltas or {}).items():
            path = f"{self.root}/tables/{run}/{name}-{uuid.uuid4().hex}"
            told = self._written(df, path)
            if told["n"]:
                paths = [*(tables[name]["paths"] if name in tables else []), path]
                tables[name], moved[name] = {"paths": paths, "key": key, "told": told}, told["n"]
                if len(paths) > most:
                    together = f"{self.root}/tables/{run}/{name}-{uuid.uuid4().hex}"
                    told = self._written(self.table(name, df.schema.simpleString()[7:-1].replace(":", " "), {"tables": tables}), together)
                    tables[name] = {"paths": [together], "key": key, "told": told}
        if moved:
            self._commit((commits[-1]["seq"] + 1 if commits else 1, run, at, json.dumps(tables, sort_keys=True)))
        return moved

    def _commit(self, row: tuple) -> None:
        self.spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("error").json(f"{self.root}/commits/seq{row[0]}")

    def swept(self, keep: int = 2) -> list[str]:
        """Removes the tables that none of the last ``keep`` commits names, with trials that were never committed; returns their folders."""
        held = {x for c in self.commits()[-keep:] for t in c["tables"].values() for x in t["paths"]}
        runs = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/tables")
        system = runs.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        gone = []
        for run in system.listStatus(runs) if system.exists(runs) else ():
            for table in system.listStatus(run.getPath()):
                name = f"{self.root}/tables/{run.getPath().getName()}/{table.getPath().getName()}"
                if name not in held and system.delete(table.getPath(), True):
                    gone.append(name)
        return gone


def write_files(rows: DataFrame, stored: DataFrame, folder: str, suffix: str = ".json") -> DataFrame:
    """Writes the content of ``rows`` (key, part, content) to ``folder/part/key`` where its digest isn't that of ``stored`` (key, digest); other files stay.

    Executors write each file under a name of the attempt and rename it, so a file is there whole or not at all. Returns (key, file, digest) of
    the files written, as a plan: its action writes. Characters that a file's name can't have become ``-``; a null part is the folder itself.
    """
    fresh = rows.select(F.col("key").cast("string"), "part", "content", F.sha2("content", 256).alias("digest"))
    held = stored.select(F.col("key").cast("string").alias("_key"), F.col("digest").alias("_digest"))
    moved = fresh.where("key is not null and content is not null").join(held, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left_anti")
    clean = lambda c: F.regexp_replace(c, r"[^A-Za-z0-9._~()-]", "-")
    named = moved.select("key", F.concat_ws("/", clean(F.col("part")), F.concat(clean(F.col("key")), F.lit(suffix))).alias("file"), "digest", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        for batch in batches:
            for file, content in zip(batch["file"].to_pylist(), batch["content"]):
                path = posixpath.join(root, file)
                trial = posixpath.join(posixpath.dirname(path), f".{uuid.uuid4().hex}")
                system.create_dir(posixpath.dirname(path), recursive=True)
                with system.open_output_stream(trial) as out:
                    out.write(content.as_py().encode())
                system.move(trial, path)
            yield batch.select(["key", "file", "digest"])

    return named.mapInArrow(run, WRITTEN)
