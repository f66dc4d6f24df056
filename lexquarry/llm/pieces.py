"""Exact merge-type (BPE) piece encoding by backtracking, and decoding.

A text is encoded left to right. At each place an Aho-Corasick automaton has told the longest
vocabulary piece; a piece may follow another only if merging the two texts anew gives just these
two pieces; if none may follow, the search steps back, and a bitfield remembers places from
which no way leads on, so that the work stays linear. With byte fallback, characters outside
the vocabulary become bytes. Runs of the space mark have tied scores, for which pair checks do
not hold; such runs are merged directly, leftmost first.

Edge cases: a null text counts as empty and has no ids; a repeated row is encoded each time; very
long texts are cut where no piece can reach over, so state is bounded by one segment; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_batch

MODEL = "piece_bpe_32k.model"
SPACE = "\u2581"
CACHE_BYTES, CACHE_PAIRS, KEPT = 60 << 20, 600_000, 64  # bytes of kept segments, all told; longest one that is kept
SHORT, NONE = 48, float("-inf")


class PieceCoder:
    """One per worker process and model: see ``coder``."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_at = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes_at.items()}
        names = {i: model.id_to_piece(i) for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.ids = {piece: i for i, piece in names.items()}
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        self.chars = {c for piece in self.ids for c in piece}
        if self.chars - self.ids.keys() or any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece has a character that is no piece, or a space after a letter")
        self.shown = [names.get(i, "").replace(SPACE, " ") for i in range(size)]
        self.decimal = [str(i) for i in range(size)]
        #: Pieces that the merging of their own text gives; no other can come up.
        self.own = {piece for piece in self.ids if piece.count(SPACE) < 2 and (len(piece) == 1 or self.merge(piece) == [piece])}
        self.automaton = ahocorasick.Automaton()
        for piece in self.own:
            if len(piece) > 1:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.shorter: dict[str, str | None] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.held = 0
        self.segments = re.compile(rf"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n" if "\n" not in self.chars else rf"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def merge(self, text: str) -> list[str]:
        """The pieces of known characters by merging best pairs first, leftmost on ties."""
        return self._merge_short(text) if len(text) <= SHORT else self._merge_long(text)

    def _merge_short(self, text: str) -> list[str]:
        """One list of the pairs' scores, looked through for each merge: far less work than a heap while it is short."""
        parts, score = list(text), self.scores.get
        pairs = [score(a + b, NONE) for a, b in zip(parts, parts[1:])]
        while pairs and (best := max(pairs)) != NONE:
            i = pairs.index(best)
            parts[i : i + 2] = (parts[i] + parts[i + 1],)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score(parts[i] + parts[i + 1], NONE)
            if i:
                pairs[i - 1] = score(parts[i - 1] + parts[i], NONE)
        return parts

    def _merge_long(self, text: str) -> list[str]:
        parts, scores = list(text), self.scores
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (pair := parts[i] + parts[j]) in scores:
                heapq.heappush(heap, (-scores[pair], i, len(pair)))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, size = heapq.heappop(heap)
            if parts[i] and (j := after[i]) < len(parts) and len(parts[i]) + len(parts[j]) == size:
                parts[i] += parts[j]
                parts[j], after[i] = "", after[j]
                if after[i] < len(parts):
                    before[after[i]] = i
                offer(i)
                if before[i] >= 0:
                    offer(before[i])
        return [x for x in parts if x]

    def _fits(self, left: str, right: str) -> bool:
        """Whether merging both texts anew gives just these two pieces; kept in ``pairs``."""
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        found = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return found

    def _prefix(self, piece: str | None) -> str | None:
        """The longest piece that begins ``piece`` and is shorter, by merging of its own."""
        if piece not in self.shorter:
            cut = piece[:-1]
            while cut and cut not in self.own:
                cut = cut[:-1]
            self.shorter[piece] = cut or None
        return self.shorter[piece]

    def backtrack(self, text: str) -> list[str]:
        """The pieces of known characters, by longest matches and steps back."""
        size, pairs = len(text), self.pairs
        longest = [1] * size
        for end, n in self.automaton.iter(text):  # of one start, later ends are longer pieces
            longest[end - n + 1] = n
        out: list[str] = []
        failed: bytearray | None = None
        at, last = 0, None
        piece: str | None = text[: longest[0]] if text else None
        while at < size:
            while piece is not None:
                end = at + len(piece)
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    found = pairs.get((last, piece))
                    if found or (found is None and self._fits(last, piece)):
                        break
                piece = self._prefix(piece)
            if piece is not None:
                out.append(piece)
                last, at = piece, end
                piece = text[at : at + longest[at]] if at < size else None
            elif out:
                failed = failed or bytearray(size // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None
                piece = self._prefix(piece)
            else:
                raise AssertionError(f"no encoding of {text!r}")
        return out

    def _segment(self, text: str) -> tuple[int, ...]:
        if text in self.own:
            return (self.ids[text],)
        way = self.merge if SPACE * 2 in text else self.backtrack
        if self.chars.issuperset(text):
            return tuple(map(self.ids.__getitem__, way(text)))
        return tuple(chain.from_iterable(self._known(text, way)))

    def _known(self, text: str, way) -> Iterator[Iterable[int]]:
        """Stretches of known characters the given way, the others as bytes."""
        start, chars = 0, self.chars
        for i, c in enumerate(text):
            if c not in chars:
                if start < i:
                    yield map(self.ids.__getitem__, way(text[start:i]))
                yield map(self.bytes_at.__getitem__, c.encode())
                start = i + 1
        if start < len(text):
            yield map(self.ids.__getitem__, way(text[start:]))

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        segments, known = self.segments(SPACE + text.replace(" ", SPACE)), self.known
        fresh = set(segments).difference(known)
        if self.held > CACHE_BYTES:
            known.clear()
            self.held, fresh = 0, set(segments)
        long = []
        for segment in fresh:
            known[segment] = ids = self._segment(segment)
            self.held += 200 + 2 * len(segment) + 12 * len(ids)
            if len(segment) > KEPT:
                long.append(segment)
        out = list(chain.from_iterable(map(known.__getitem__, segments)))
        for segment in long:
            self.held -= 200 + 2 * len(segment) + 12 * len(known.pop(segment))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: spaces for space marks, bytes joined, the first mark's space gone."""
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join(map(self.shown.__getitem__, ids))
        else:
            parts, run = [], bytearray()
            for i in ids:
                if i in self.byte_of:
                    run.append(self.byte_of[i])
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                parts.append(self.shown[i])
            text = "".join(parts) + run.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def encode_decode(docs: DataFrame, model: str, texts: bool = False) -> DataFrame:
    """Ids' number and digests of each document (doc_id, text); with ``texts``, the ids too."""

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if texts else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = coder(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some, rows = batch.slice(start, 500), []
                for text in some["text"]:
                    ids = codec.encode(text.as_py() or "")
                    joined = ",".join(map(codec.decimal.__getitem__, ids)).encode()
                    rows.append((len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest(), *([ids] if texts else [])))
                yield arrow_batch(schema, some["doc_id"], *map(list, zip(*rows, strict=True)))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), public_tokenizers.path(MODEL))


QUERIES = {"op5_piece_codec": op5_piece_codec}
