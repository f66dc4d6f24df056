"""The folder that driver and executors share, and files in it.

The session names the folder in ``spark.checkpoint.dir``. Only where that is unset and Spark runs
in one process (tests, a laptop) a temporary folder is made; on a cluster that is an error. Files are written under a name of the attempt and then
renamed, so a lost executor or a second attempt leaves either no file or the whole one.
"""

from __future__ import annotations

import os
import posixpath
import tempfile
import uuid
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def arrow_batch(ddl: str, *columns) -> pa.RecordBatch:
    """Columns (lists, numpy or Arrow arrays) as a batch of the schema; whole numbers stay exact beside nulls."""
    fields = [x.rsplit(" ", 1) for x in ddl.split(", ")]
    arrays = [x if isinstance(x, pa.Array) else pa.array(x, _KINDS[kind]) for x, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema([(name, _KINDS[kind]) for name, kind in fields]))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have, whatever the case of letters."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_root(spark: SparkSession) -> str:
    """URI of the shared folder named by the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="lexquarry-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh URI below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/lexquarry/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    schema = df.schema
    df.write.parquet(path, compression=codec)
    return spark.read.schema(schema).parquet(path)


def _local(uri: str) -> str | None:
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return unquote(parts.path) if parts.scheme else uri
    return None


def _remote(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, data) -> str:
    """Write bytes (or an iterable of byte blocks) whole or not at all; returns the file's URI."""
    blocks = (data,) if isinstance(data, (bytes, bytearray, memoryview)) else data
    trial = f".{name}.{uuid.uuid4().hex}"
    if (path := _local(folder)) is not None:
        os.makedirs(path, exist_ok=True)
        with open(os.path.join(path, trial), "wb") as out:
            for block in blocks:
                out.write(block)
        os.replace(os.path.join(path, trial), os.path.join(path, name))
    else:
        system, path = _remote(folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(posixpath.join(path, trial)) as out:
            for block in blocks:
                out.write(block)
        system.move(posixpath.join(path, trial), posixpath.join(path, name))
    return f"{folder}/{name}"


def open_file(uri: str):
    """A readable binary file that can seek."""
    if (path := _local(uri)) is not None:
        return open(path, "rb")
    system, path = _remote(uri)
    return system.open_input_file(path)
