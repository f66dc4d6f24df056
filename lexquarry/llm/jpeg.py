"""Baseline JPEG as a lossless store of bytes, its parser, and DC-only thumbnails.

A payload byte becomes one quantised coefficient of magnitude category 8, whose eight extra bits
are the byte itself; a block holds 64 of them, and each block is a restart interval, so that DC
differences start anew and intervals decode side by side. Nine blocks, 24 by 24 pixels, are the
unit; an image is 24 pixels wide, and payloads over ``GROUPS`` units go to several images in a row.

The decoder takes any baseline JPEG of one component: it parses markers, Huffman and quantiser tables, undoes byte
stuffing, and Huffman-decodes all restart intervals in step, one table lookup a symbol. DC values alone give
the thumbnail: one pixel a block.

Edge cases: a null text counts as empty, and an empty payload is padded to one unit; equal texts
give equal values; extra columns are ignored; an empty table gives no rows. Texts are taken in
groups of bounded size, so memory is bounded by ``GROUP_BYTES`` and the longest text.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_batch, staged

UNIT, PAD, BLOCKS_WIDE, GROUPS = 576, 255, 3, 2730
GROUP_BYTES = 2 << 20
STORED = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
#: Symbol 8 (DC: category 8; AC: no zeros before, category 8) has the one-bit code 0.
_TABLE = bytes([1, *[0] * 15, 8])


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode()
    return raw + bytes([PAD]) * (UNIT - len(raw) % UNIT if len(raw) % UNIT or not raw else 0), len(raw)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _head(units: int) -> bytes:
    return b"".join([
        b"\xff\xd8",
        _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0"),
        _segment(0xDB, b"\0" + b"\1" * 64),
        _segment(0xC0, struct.pack(">BHHBBBB", 8, 24 * units, 8 * BLOCKS_WIDE, 1, 1, 0x11, 0)),
        _segment(0xC4, b"\x00" + _TABLE),
        _segment(0xC4, b"\x10" + _TABLE),
        _segment(0xDD, struct.pack(">H", 1)),
        _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
    ])


def encode(payloads: list[bytes]) -> list[bytes]:
    """The JPEG bytes of each payload (a positive multiple of ``UNIT`` bytes)."""
    images = [x[i : i + UNIT * GROUPS] for x in payloads for i in range(0, len(x), UNIT * GROUPS)]
    counts = np.array([len(x) // 64 for x in images])
    data = np.frombuffer(b"".join(images), np.uint8)
    bits = np.zeros((len(data), 9), np.uint8)
    bits[:, 1:] = np.unpackbits(data).reshape(-1, 8)
    scan = np.empty((len(data) // 64, 74), np.uint8)
    scan[:, :72] = np.packbits(bits.reshape(-1, 576), axis=1)
    scan[:, 72] = 0xFF
    ends = np.cumsum(counts)
    scan[:, 73] = 0xD0 + (np.arange(len(scan)) - np.repeat(ends - counts, counts)) % 8
    stuffed = scan == 0xFF
    stuffed[:, 72] = False
    twice = stuffed.ravel().astype(np.int8) + 1
    flat = np.repeat(scan.ravel(), twice)
    at = np.cumsum(twice, dtype=np.int64)
    flat[at[np.flatnonzero(stuffed.ravel())] - 1] = 0
    limits = [0, *at[ends * 74 - 1].tolist()]
    whole, out, made = flat.tobytes(), [], iter(zip(limits, limits[1:], counts.tolist(), strict=False))
    for x in payloads:
        parts = []
        for _ in range(0, len(x), UNIT * GROUPS):
            a, b, n = next(made)
            parts += [_head(n // 9), whole[a : b - 2], b"\xff\xd9"]
        out.append(b"".join(parts))
    return out


def _lookup(table: bytes) -> np.ndarray:
    """For the next 16 bits: symbol << 8 | length of its code; 0 where no code is."""
    found, code, at = np.zeros(1 << 16, np.int32), 0, 16
    for length in range(1, 17):
        for _ in range(table[length - 1]):
            start = code << (16 - length)
            found[start : start + (1 << (16 - length))] = table[at] << 8 | length
            code, at = code + 1, at + 1
        code <<= 1
    return found


def _frames(data: bytes) -> Iterator[tuple[int, int, bytes, bytes, int, int, int, int]]:
    """Of each image in ``data``: width, height, DC table, AC table, restart interval, scan's start and end, DC's quantiser."""
    at = 0
    while at < len(data):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError("no image starts here")
        at, size, tables, interval, steps, used = at + 2, None, {}, 0, {}, 0
        while True:
            mark, length = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body, at = data[at + 4 : at + 2 + length], at + 2 + length
            if mark == 0xC0:
                size, used = struct.unpack(">HH", body[1:5]), body[8]
                if body[0] != 8 or body[5] != 1:
                    raise ValueError("not a grey image of 8 bits")  # one component's sampling has no effect
            elif mark == 0xDB:
                while body:
                    wide = body[0] >> 4
                    steps[body[0] & 15] = int.from_bytes(body[1 : 2 + wide])
                    body = body[1 + 64 * (1 + wide) :]
            elif 0xC1 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not a baseline image")
            elif mark == 0xC4:
                while body:
                    n = 17 + sum(body[1:17])
                    tables[body[0]], body = body[1:n], body[n:]
            elif mark == 0xDD:
                interval = struct.unpack(">H", body)[0]
            elif mark == 0xDA:
                end = data.index(b"\xff\xd9", at)
                dc, ac = body[2] >> 4, body[2] & 15
                yield size[1], size[0], tables[dc], tables[0x10 | ac], interval, at, end, steps[used]
                at = end + 2
                break


def _decode_scans(scans: list[bytes], blocks: list[int], interval: int, dc: bytes, ac: bytes) -> np.ndarray:
    """Coefficients (block, place in zigzag order) of scans that share tables; DC values are summed up."""
    joined = np.frombuffer(b"\xff\xd9".join(scans) + b"\xff\xd9", np.uint8)
    after = np.concatenate([[0], (joined[:-1] == 0xFF)]).astype(bool)
    marks = np.flatnonzero(after & (joined >= 0xD0) & (joined <= 0xD9))
    gone = after & (joined == 0)
    gone[marks] = gone[marks - 1] = True
    kept = np.cumsum(~gone)
    data = np.concatenate([joined[~gone], np.zeros(16, np.uint8)])
    starts = np.concatenate([[0], kept[marks][:-1]])
    each = np.concatenate([np.full(-(-n // (interval or n)), interval or n) for n in blocks])
    last = np.cumsum([-(-n // (interval or n)) for n in blocks]) - 1
    each[last] = [n - (interval or n) * (-(-n // (interval or n)) - 1) for n in blocks]
    if len(each) != len(starts):
        raise ValueError("restart intervals are missing")
    word = data[:-3].astype(np.uint32) << 24 | data[1:-2].astype(np.uint32) << 16 | data[2:-1].astype(np.uint32) << 8 | data[3:]
    out = np.zeros((int(sum(blocks)), 64), np.int16)
    first = np.cumsum(each) - each
    bit, dc_at, ac_at = starts.astype(np.int64) * 8, _lookup(dc), _lookup(ac)

    def take(where: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = table[(word[where >> 3] << (where & 7).astype(np.uint32)) >> np.uint32(16)]
        if not found.all():
            raise ValueError("no such code")
        return found >> 8, where + (found & 255)

    def value(where: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bits = ((word[where >> 3] << (where & 7).astype(np.uint32)) >> (31 - size).astype(np.uint32) >> np.uint32(1)).astype(np.int32)
        return np.where(bits < (1 << size >> 1), bits - (1 << size) + 1, bits), where + size

    for turn in range(int(each.max(initial=0))):
        lanes = np.flatnonzero(each > turn)
        rows, where = first[lanes] + turn, bit[lanes]
        size, where = take(where, dc_at)
        diff, where = value(where, size)
        out[rows, 0] = diff + (out[rows - 1, 0] if turn else 0)
        k = np.ones(len(lanes), np.int64)
        todo = np.arange(len(lanes))
        while len(todo):
            symbol, now = take(where[todo], ac_at)
            size, run = symbol & 15, symbol >> 4
            got, now = value(now, size)
            where[todo] = now
            place = k[todo] + run
            real = size > 0
            if real.all():
                out[rows[todo], place] = got
                k[todo] = place + 1
            else:
                out[rows[todo][real], place[real]] = got[real]
                k[todo] = np.where(symbol == 0, 64, place + 1)
            todo = todo[k[todo] < 64]
        bit[lanes] = where
    return out


def decode(media: list[bytes]) -> list[tuple[bytes, list[tuple[int, int, np.ndarray]]]]:
    """Of each stored form: the payload, and (width, height, thumbnail) of its images."""
    frames = [(k, *frame) for k, data in enumerate(media) for frame in _frames(data)]
    groups: dict[tuple, list[int]] = {}
    for i, (_, _, _, dc, ac, interval, *_) in enumerate(frames):
        groups.setdefault((dc, ac, interval), []).append(i)
    out: list[tuple[list[bytes], list]] = [([], []) for _ in media]
    found: dict[int, np.ndarray] = {}
    for (dc, ac, interval), members in groups.items():
        blocks = [(-(-frames[i][1] // 8)) * (-(-frames[i][2] // 8)) for i in members]
        scans = [media[frames[i][0]][frames[i][6] : frames[i][7]] for i in members]
        values, at = _decode_scans(scans, blocks, interval, dc, ac), 0
        for i, n in zip(members, blocks, strict=True):
            found[i], at = values[at : at + n], at + n
    for i, (k, width, height, _, _, interval, _, _, step) in enumerate(frames):
        values = found[i]
        diffs = values.copy()
        turn = np.arange(len(values)) % interval if interval else np.arange(len(values))
        diffs[turn > 0, 0] -= values[np.flatnonzero(turn > 0) - 1, 0]
        out[k][0].append(np.where(diffs < 0, diffs + 255, diffs).astype(np.uint8).tobytes())
        thumb = np.clip(values[:, 0] * step / 8 + 128, 0, 255).astype(np.uint8).reshape(-(-height // 8), -(-width // 8))
        out[k][1].append((width, height, thumb))
    return [(b"".join(parts), images) for parts, images in out]


def feature(images: list[tuple[int, int, np.ndarray]]) -> str:
    """Dimensions and thumbnail hashes of a stored form's images."""
    return ",".join(f"{w}x{h}:{hashlib.sha256(thumb.tobytes()).hexdigest()[:16]}" for w, h, thumb in images)


def _groups(values: list, size) -> Iterator[list]:
    held, n = [], 0
    for x in values:
        held.append(x)
        n += size(x)
        if n >= GROUP_BYTES:
            yield held
            held, n = [], 0
    if held:
        yield held


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media) of each document (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True))
            for some in _groups(rows, lambda x: len(x[1] or "")):
                whole = [padded(text) for _, text in some]
                yield arrow_batch(STORED, [x for x, _ in some], [n for _, n in whole], encode([x for x, _ in whole]))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, STORED)


def features(stored: DataFrame) -> DataFrame:
    """What the stored bytes decode to, and their features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(batch["doc_id"].to_pylist(), batch["n_bytes"].to_pylist(), batch["media"].to_pylist(), strict=True))
            for some in _groups(rows, lambda x: len(x[2])):
                out = []
                for (doc, n, media), (payload, images) in zip(some, decode([x[2] for x in some]), strict=True):
                    out.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(images)))
                yield arrow_batch(FEATURES, *map(list, zip(*out, strict=True)))

    return stored.mapInArrow(run, FEATURES)


def op7_jpeg_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Scans are shifted bit by bit from block to block, which gzip packs to two thirds of what snappy does.
    return features(staged(store(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), "media", "gzip"))


QUERIES = {"op7_jpeg_columns": op7_jpeg_columns}
