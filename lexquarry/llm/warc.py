"""WARC archives: one gzip member a record, written once per payload, and a sequential reader.

Of records with equal payloads of at least ``LEAST`` bytes, that with the largest page_id is the
response and the others are revisits that refer to it. The reader streams an archive: zlib is
fed block by block, a record's header ends at the first empty line, Content-Length frames its
block, and block and payload digests are verified.

Edge cases: a null html is an empty payload; a null url is an empty target; a null page_id never
is referred to, and rows with one are responses unless a row of equal payload has an id; rows
that repeat page_id and payload are each responses if theirs is the largest id; extra columns are
ignored; an empty table gives no archive and no rows. Memory is bounded by one record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_batch, new_folder, open_file, write_file

LEAST = 1000
ARCHIVE_BYTES = 32 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROWS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One gzip member: a response, or a revisit if ``refers_to`` names another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: {_base32(hashlib.sha1(payload).digest())}",
        f"WARC-Block-Digest: {_base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def members(blocks: Iterable[bytes]) -> Iterator[bytes]:
    """The decompressed bytes of each gzip member of a stream."""
    unpacker, parts, begun = zlib.decompressobj(31), [], False
    for block in blocks:
        while block:
            parts.append(unpacker.decompress(block))
            begun, block = True, b""
            if unpacker.eof:
                yield b"".join(parts)
                begun, block, unpacker, parts = False, unpacker.unused_data, zlib.decompressobj(31), []
    if begun:
        raise ValueError("archive ends inside a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; raises if framing or a digest is wrong."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(fields["Content-Length"])
    if not found or not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("record isn't framed by its length")
    block = rest[:size]
    if _base32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError("block digest differs")
    return fields, block


def describe(fields: dict[str, str], block: bytes) -> tuple:
    """The row of a record, its payload's digest checked where it holds one."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError("payload digest differs")
    page, other = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
    return page and int(page), size, digest.hex(), fields["WARC-Type"], other and int(other), fields["WARC-Target-URI"]


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seq, held, size = TaskContext.get(), 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held, size
            name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{seq:04d}.warc.gz"
            write_file(folder, name, held)
            seq, held, size = seq + 1, [], 0
            return arrow_batch("file string", [name])

        for batch in batches:
            for page, url, html, latest in zip(*(batch[x] for x in ("page_id", "url", "html", "latest")), strict=True):
                number, other = page.as_py(), latest.as_py()
                held.append(record(number, url.as_py() or "", (html.as_py() or "").encode(), None if number == other else other))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    return write


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["file"].to_pylist():
                rows = []
                with open_file(f"{folder}/{name}") as file:
                    for data in members(iter(lambda file=file: file.read(1 << 16), b"")):
                        rows.append(describe(*parse(data)))
                        if len(rows) == 2000:
                            yield arrow_batch(ROWS, *map(list, zip(*rows, strict=True)))
                            rows = []
                if rows:
                    yield arrow_batch(ROWS, *map(list, zip(*rows, strict=True)))

    return read


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write archives of ``pages`` (page_id, url, html) to ``folder``; one row per file."""
    spark = pages.sparkSession
    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = own.withColumn("digest", F.when(F.octet_length("html") >= LEAST, F.sha1("html")))
    latest = keyed.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    written = keyed.join(latest, "digest", "left").select("page_id", "url", "html", "latest").mapInArrow(_writer(folder), "file string")
    written.write.parquet(f"{folder}/manifest")
    return spark.read.schema("file string").parquet(f"{folder}/manifest")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts, "file").mapInArrow(_reader(folder), ROWS)


def op6_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_archives(write_archives(pages, folder), folder)


QUERIES = {"op6_warc_records": op6_warc_records}
ORACLE_SQL = {
    "op6_warc_records": """
with p as (
  select page_id, url, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n from pages
), k as (
  select page_id, url, n, sha1(html) as digest, max(page_id) over (partition by html) as latest from p
)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
  case when n >= 1000 and page_id <> latest then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id <> latest then latest end as refers_to,
  url as target
from k"""
}
