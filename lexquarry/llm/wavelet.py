"""Token-ID output as wavelet matrices.

A shard file holds the token ids of consecutive documents as a wavelet matrix: one bit-plane per
bit of an id, each with a rank directory, both in chunks of their own compression. ``access``, ``count`` and
``occurrences`` read the chunks that they need, without decoding the other tokens; ``decode`` restores all ids at once.

Edge cases: a null text counts as empty, an empty text is the end id alone; rows that repeat a
doc_id each keep their own place, ordered by (doc_id, text); a null doc_id sorts first; columns
other than the two named are ignored; an empty table gives no files and no rows.

Memory is bounded by ``SHARD_TOKENS``: a task holds one shard, and a document longer than that
makes one shard of its own.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import arrow_batch, new_folder, open_file, write_file

MAGIC = b"LQWM0001"
SHARD_TOKENS = 2_000_000
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
CACHE_PIECES = 1_000_000
BLOCK = 512  # bits between entries of the rank directory
CHUNK = 1 << 15  # bytes of a plane that are compressed together, a multiple of BLOCK / 8
FILES = "part int, seq int, file string, n long"
PLACES = "doc_id long, start long, n_tokens long, ids_crc32 long, shard string, last_id long, n_ends long"


class Chunked:
    """An array in compressed chunks of a file, read when it is asked for."""

    def __init__(self, file, offsets: list[int], kind, size: int):
        self.file, self.offsets, self.kind, self.size = file, offsets, np.dtype(kind), size
        self.each = CHUNK // self.kind.itemsize
        self.read: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return self.size

    def _chunk(self, i: int) -> np.ndarray:
        import zstandard

        if i not in self.read:
            self.file.seek(self.offsets[i])
            self.read[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.file.read(self.offsets[i + 1] - self.offsets[i])), self.kind)
        return self.read[i]

    def take(self, places: np.ndarray) -> np.ndarray:
        chunk, out = places // self.each, np.empty(places.shape, self.kind)
        for i in np.unique(chunk):
            here = chunk == i
            out[here] = self._chunk(int(i))[places[here] - i * self.each]
        return out

    def whole(self) -> np.ndarray:
        return np.concatenate([self._chunk(i) for i in range(len(self.offsets) - 1)])


class Held:
    """The same over an array in memory."""

    def __init__(self, values: np.ndarray):
        self.values = values

    def __len__(self) -> int:
        return len(self.values)

    def take(self, places: np.ndarray) -> np.ndarray:
        return self.values[places]

    def whole(self) -> np.ndarray:
        return self.values


class WaveletMatrix:
    """Bit-planes (most significant first) with rank directories over ``n`` ids."""

    def __init__(self, planes, ranks, zeros, n):
        self.planes, self.ranks, self.zeros, self.n = planes, ranks, zeros, n

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        width = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        ids = ids.astype(np.uint16) if width <= 16 else ids
        planes, ranks, zeros, now = [], [], [], ids
        for level in range(width - 1, -1, -1):
            bits = ((now >> now.dtype.type(level)) & 1).astype(bool)
            packed = np.packbits(bits, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8) + BLOCK // 8, np.uint8)])
            ones = np.bitwise_count(packed.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1)
            ranks.append(Held(np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32)))
            planes.append(Held(packed))
            zeros.append(len(bits) - int(bits.sum()))
            now = np.concatenate([now.compress(~bits), now.compress(bits)])
        return cls(planes, ranks, zeros, len(ids))

    def _ranks(self, level: int, places: np.ndarray) -> np.ndarray:
        """Ones among the first bits of a plane, for each of ``places``."""
        block, width = places // BLOCK, BLOCK // 8
        data = self.planes[level].take(block[:, None] * width + np.arange(width))
        inside = places % BLOCK
        full = np.arange(width) < (inside // 8)[:, None]
        part = data[np.arange(len(places)), inside // 8] & ((1 << (inside % 8)) - 1).astype(np.uint8)
        return self.ranks[level].take(block).astype(np.int64) + (np.bitwise_count(data) * full).sum(1, dtype=np.int64) + np.bitwise_count(part)

    def rank1(self, level: int, i: int) -> int:
        return int(self._ranks(level, np.array([i]))[0])

    def select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit of a plane."""
        low, high = 0, len(self.ranks[level]) - 1

        def before(b: int) -> int:
            ones = int(self.ranks[level].take(np.array([b]))[0])
            return ones if bit else b * BLOCK - ones

        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if before(middle) <= k else (low, middle - 1)
        bits = np.unpackbits(self.planes[level].take(low * BLOCK // 8 + np.arange(BLOCK // 8)), bitorder="little")
        return low * BLOCK + int(np.flatnonzero(bits == bit)[k - before(low)])

    def accessed(self, places: np.ndarray) -> np.ndarray:
        """The ids at ``places``."""
        now, values = np.asarray(places, np.int64), np.zeros(len(places), np.int64)
        for level, zeros in enumerate(self.zeros):
            bits, ones = self.planes[level].take(now >> 3) >> (now & 7).astype(np.uint8) & 1, self._ranks(level, now)
            values = values << 1 | bits
            now = np.where(bits == 1, zeros + ones, now - ones)
        return values

    def access(self, i: int) -> int:
        return int(self.accessed(np.array([i]))[0])

    def _ranges(self, value: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if value < 0 or value >> len(self.zeros):
            return starts * 0, starts * 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._ranks(level, starts), self._ranks(level, ends)
            starts, ends = (zeros + a, zeros + b) if value >> (len(self.zeros) - 1 - level) & 1 else (starts - a, ends - b)
        return starts, ends

    def counted(self, value: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often ``value`` stands in each stretch."""
        a, b = self._ranges(value, np.asarray(starts, np.int64), np.asarray(ends, np.int64))
        return b - a

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        return int(self.counted(value, np.array([start]), np.array([self.n if end is None else end]))[0])

    def occurrences(self, value: int, start: int = 0, end: int | None = None) -> list[int]:
        a, b = self._ranges(value, np.array([start]), np.array([self.n if end is None else end]))
        found = []
        for i in range(int(a[0]), int(b[0])):
            for level in range(len(self.zeros) - 1, -1, -1):
                bit = value >> (len(self.zeros) - 1 - level) & 1
                i = self.select(level, bit, i - self.zeros[level] if bit else i)
            found.append(i)
        return found

    def decode(self) -> np.ndarray:
        """All ids: the last plane's order is undone plane by plane."""
        kind = np.uint16 if len(self.zeros) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for level in range(len(self.zeros) - 1, -1, -1):
            bits = np.unpackbits(self.planes[level].whole(), count=self.n, bitorder="little").astype(bool)
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~bits)] = ids[: self.zeros[level]]
            out[np.flatnonzero(bits)] = ids[self.zeros[level] :] | kind(1 << (len(self.zeros) - 1 - level))
            ids = out
        return ids


def dump(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], base: int) -> bytes:
    """One shard file: magic, header, then document index, planes and directories in chunks, zstd-compressed."""
    import zstandard

    matrix, packer = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1)
    parts = [
        np.array([x is None for x in doc_ids], np.uint8),
        np.array([x or 0 for x in doc_ids], np.int64),
        np.array(lengths, np.int64),
        *(x.whole() for pair in zip(matrix.planes, matrix.ranks, strict=True) for x in pair),
    ]
    packed = [[packer.compress(x.tobytes()[i : i + CHUNK]) for i in range(0, x.nbytes, CHUNK)] for x in parts]
    head = json.dumps({"n": matrix.n, "base": base, "zeros": matrix.zeros, "parts": [[len(x), *map(len, p)] for x, p in zip(parts, packed, strict=True)]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *(x for p in packed for x in p)])


def load(source) -> tuple[WaveletMatrix, list[int | None], np.ndarray, int]:
    """(matrix, doc ids, lengths, number of ids before this shard in its partition) of a shard's bytes, or of a file that can seek, which stays in use."""
    file = io.BytesIO(source) if isinstance(source, bytes) else source
    if file.read(8) != MAGIC:
        raise ValueError("not a wavelet shard")
    size = struct.unpack("<I", file.read(4))[0]
    head, at, parts = json.loads(file.read(size)), 12 + size, []
    for i, (n, *chunks) in enumerate(head["parts"]):
        offsets = np.cumsum([at, *chunks]).tolist()
        kind = np.uint8 if i == 0 else np.int64 if i < 3 else np.uint8 if i % 2 else np.uint32
        parts.append(Chunked(file, offsets, kind, n))
        at = offsets[-1]
    docs = [None if gone else int(x) for gone, x in zip(parts[0].whole(), parts[1].whole(), strict=True)]
    return WaveletMatrix(parts[3::2], parts[4::2], head["zeros"], head["n"]), docs, parts[2].whole(), head["base"]


class WordEncoder:
    """The tokenizers library's ids of whole texts, by way of its pre-tokenizer's pieces.

    A text of printable ASCII, Latin-1 letters, spaces and line feeds is cut into pieces here and
    each new piece goes to the library's BPE model. Any other text is cut at spaces and line
    feeds, which this vocabulary's normaliser and pre-tokenizer never join or look across; its
    plain runs are treated likewise and the rest go to the library. Ids of pieces are kept. That holds for
    vocabularies of these ``RULES``; with any other, whole texts go to the library.
    """

    #: The normaliser and pre-tokenizer for which pieces can be cut here.
    RULES = (
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    )

    PLAIN = re.compile(r"(?:[!-;=-~\xc0-\xd6\xd8-\xf6\xf8-\xff \n]|<(?!\|))*+").fullmatch
    #: Fixed value: the vocabulary's own pre-tokenizer pattern, for such texts in lower case.
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^ \na-z0-9\xdf-\xf6\xf8-\xff]+").findall

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.model = self.tokenizer.model
        rules = json.loads(self.tokenizer.to_str())
        self.cut = (rules["normalizer"], rules["pre_tokenizer"]) == self.RULES and rules["model"]["type"] == "BPE" and all("<|" in x["content"] for x in rules["added_tokens"])
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level BPE shows these bytes as themselves
        self.shown = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}

    def _piece(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.shown)
        found = self.model.tokenize(raw)
        return struct.pack(f"<{len(found)}I", *[x.id for x in found])

    def _plain(self, text: str) -> bytes:
        pieces, known = self.PIECES(text.lower()), self.known
        fresh = set(pieces).difference(known)
        if len(known) + len(fresh) > CACHE_PIECES and known:
            known.clear()
            fresh = set(pieces)
        for piece in fresh:
            known[piece] = self._piece(piece)
        return b"".join(map(known.__getitem__, pieces))

    def _run(self, run: str) -> bytes:
        if self.PLAIN(run):
            return self._plain(run)
        ids = self.tokenizer.encode(run, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not self.cut:
            return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return [self._plain(x) if self.PLAIN(x) else b"".join(map(self._run, x.replace("\n", " ").split(" "))) for x in texts]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One a worker process."""
    return WordEncoder(path)


def _writer(folder: str, path: str, end_id: int, shard_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, seq, base = word_encoder(path), TaskContext.get().partitionId(), 0, 0
        end = struct.pack("<I", end_id)
        docs: list[int | None] = []
        rows: list[bytes] = []
        size = 0

        def flush():
            nonlocal docs, rows, size, seq, base
            ids = np.frombuffer(b"".join(rows), "<u4")
            name = f"part-{part:06d}-{seq:06d}.wvm"
            write_file(folder, name, dump(ids, docs, [len(x) // 4 for x in rows], base))
            line = arrow_batch(FILES, [part], [seq], [name], [len(ids)])
            docs, rows, size, seq, base = [], [], 0, seq + 1, base + len(ids)
            return line

        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                texts = [x or "" for x in some["text"].to_pylist()]
                for doc, ids in zip(some["doc_id"].to_pylist(), encoder.encode(texts), strict=True):
                    docs.append(doc)
                    rows.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= shard_tokens:
                        yield flush()
        if rows:
            yield flush()

    return write


def _reader(folder: str, end_id: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, name in zip(batch["before"].to_pylist(), batch["file"].to_pylist(), strict=True):
                with open_file(f"{folder}/{name}") as file:
                    matrix, docs, lengths, base = load(file)
                    ids = matrix.decode().astype("<u4", copy=False)
                    ends = np.cumsum(lengths)
                    starts = ends - lengths
                    sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                    yield arrow_batch(PLACES, docs, before + base + starts, lengths, sums, [name] * len(docs), matrix.accessed(ends - 1), matrix.counted(end_id, starts, ends))

    return read


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write ``docs`` (doc_id, text) to ``folder`` in doc_id order; one row per file.

    Range partitions keep the order across files; each is sorted, then streamed.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.mapInArrow(_writer(folder, vocabulary, end_id, shard_tokens), FILES)
    manifest = f"{folder}/manifest"
    written.write.parquet(manifest)
    return spark.read.schema(FILES).parquet(manifest)


def read_shards(files: DataFrame, folder: str, end_id: int = END_ID) -> DataFrame:
    """Each document's place, ids' checksum, last id and number of end ids from the files that ``write_shards`` made."""
    spark = files.sparkSession
    # One row per range partition: as many as spark.sql.shuffle.partitions, whatever the corpus.
    totals = files.groupBy("part").agg(F.sum("n").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = files.join(before, "part").select("before", "file").repartition(parts, "file")
    return tasks.mapInArrow(_reader(folder, end_id), PLACES)


def op2_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "wavelet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_shards(write_shards(docs, folder, public_tokenizers.path(VOCABULARY)), folder)


QUERIES = {"op2_wavelet_shards": op2_wavelet_shards}
