"""Spelling variants by the full neighbourhood: all deletions, replacements and insertions of each word, joined to the vocabulary.

1. Words are counted text by text in Arrow batches, so a text sends each of its words once, then summed.
2. The alphabet is that of the vocabulary (its letters are those of the pattern, at most 90 after lower-casing).
3. Every word's distinct edits are made as 64-bit hashes, with numpy: a hash of letters times powers, so that an edit is a sum of a part
   before, a letter and a part after. Which edits are distinct is known by rule: a letter is deleted or inserted at the first place of
   those that give the same word.
4. Edits that can't be in the vocabulary don't travel: a Bloom filter of fixed size (``BITS``, two hashes) holds the vocabulary. It never refuses
   a word that is there; when the vocabulary outgrows it, more edits travel and the result is the same.
5. What passes is written out and joined to the vocabulary by the word itself, so no distance is verified.
6. A word's form is its commonest neighbour, where that is ``TIMES`` times as common; roots follow forms by pointer jumping (each step
   is ``TIMES`` times as common, so chains are short and have no cycle).

Edge cases: a null text has no words, an empty one neither; a null doc_id deletes nothing from its text's words; rows that repeat a doc_id are each counted;
long words are taken in blocks of places; of neighbours equally common the smallest in code-point order is the form; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .neardup import _jumped, _mix
from .shared import arrow_batch, staged

LETTERS = re.compile("[a-zÀ-ÿ]+")
LEAST, OFTEN, TIMES = 7, 2, 10
BITS = 28  # of the filter's size: 32 MiB
EVERY = 31  # of words by hash, the share from which a letter is deleted
BLOCK = 1 << 20  # edits worked on at a time
FLUSH = 1 << 18  # distinct words held before they are sent

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
COUNTS, EDITS, SLOTS = "word string, n long", "near string, word string", "slot long, bits long"


def text_words(text: str, doc_id: int | None, size: int = 1 << 20) -> Counter:
    """How often each word is in a text, after the deletions; long texts are cut where no letter is."""
    found: Counter = Counter()
    lowered, at = text.encode().lower().decode(), 0
    while at < len(lowered):
        end = min(at + size, len(lowered))
        while end < len(lowered) and LETTERS.match(lowered, end):
            end = LETTERS.match(lowered, end).end()
        found.update(LETTERS.findall(lowered, at, end))
        at = end
    if doc_id is None:
        return found
    seed, out = zlib.crc32(b"%d:" % doc_id), Counter()
    for word, n in found.items():
        h = zlib.crc32(word.encode(), seed)
        if h % EVERY == 0:
            i = h % len(word)
            word = word[:i] + word[i + 1 :]
        out[word] += n
    return out


def _counted(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                for word, n in text_words(text.as_py() or "", doc_id).items():
                    if len(word) >= least:
                        held[word] += n
                if len(held) >= FLUSH:
                    yield arrow_batch(COUNTS, list(held), list(held.values()))
                    held.clear()
        if held:
            yield arrow_batch(COUNTS, list(held), list(held.values()))

    return run


def vocabulary(docs: DataFrame, least: int = LEAST, often: int = OFTEN) -> DataFrame:
    """(word, n): words of at least ``least`` letters that ``docs`` (doc_id, text) holds at least ``often`` times."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(_counted(least), COUNTS).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= often)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in ``words`` and the matrix of letters, of words equally long."""
    lengths = np.array([len(x) for x in words], np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        for some in np.array_split(at, -(-len(at) * int(length) * 64 // BLOCK)):
            if len(some):
                yield some, np.frombuffer("".join([words[i] for i in some]).encode("utf-32-le"), np.uint32).reshape(-1, int(length)).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sums(letters: np.ndarray) -> np.ndarray:
    """Hashes of all beginnings of each word, from the empty one on."""
    out = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
    np.cumsum(letters * _powers(letters.shape[1]), axis=1, out=out[:, 1:])
    return out


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in the filter."""
    mixed = _mix(hashes)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64), (mixed & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _filter_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places = [np.concatenate(_slots(_sums(letters)[:, -1])) for _, letters in _by_length(batch["word"].to_pylist())]
        if places:
            place = np.unique(np.concatenate(places))
            slot, first = np.unique(place >> 6, return_index=True)
            yield arrow_batch(SLOTS, slot, np.bitwise_or.reduceat(np.uint64(1) << (place & 63).astype(np.uint64), first).view(np.int64))


def vocabulary_filter(words: DataFrame) -> np.ndarray:
    """The filter's bits, 64 a number: at most 2**BITS bits reach the driver, whatever the vocabulary."""
    rows = words.select("word").mapInArrow(_filter_rows, SLOTS).groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[rows["slot"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def edits(words: list[str], alphabet: np.ndarray, bits: np.ndarray, least: int = LEAST) -> Iterator[tuple[list[str], list[str]]]:
    """(edited words, words) of all distinct edits of ``words`` that the filter may hold, block by block; none shorter than ``least``."""

    def held(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Places of the hashes that pass."""
        flat = _mix(hashes.ravel())
        at = np.flatnonzero(bits[(flat >> np.uint64(70 - BITS)).view(np.int64)] & (np.uint64(1) << ((flat >> np.uint64(64 - BITS)) & np.uint64(63))))
        place = flat[at] & np.uint64((1 << BITS) - 1)
        second = bits[(place >> np.uint64(6)).view(np.int64)] & (np.uint64(1) << (place & np.uint64(63)))
        return np.unravel_index(at[second != 0], hashes.shape)

    for some, letters in _by_length(words):
        length = letters.shape[1]
        sums, powers = _sums(letters), _powers(length + 1)
        whole = sums[:, -1:]
        step = max(1, BLOCK // (len(some) * len(alphabet)))
        for a in range(0, length + 1, step):
            here, near, of = slice(a, min(a + step, length)), [], []

            def keep(rows: np.ndarray, make) -> None:
                mine = [words[i] for i in some[rows].tolist()]
                near.extend(map(make, mine, *keys))
                of.extend(mine)

            if length > least:
                row, i = held(sums[:, here] + (whole - sums[:, 1:][:, here]) * _INVERSE)
                first = (a + i == 0) | (letters[row, a + i] != letters[row, np.maximum(a + i - 1, 0)])
                row, keys = row[first], [(a + i[first]).tolist()]
                keep(row, lambda w, i: w[:i] + w[i + 1 :])
            row, i, c = held((whole + (np.uint64(0) - letters[:, here]) * powers[here])[:, :, None] + (alphabet * powers[here][:, None])[None])
            other = letters[row, a + i] != alphabet[c]
            row, keys = row[other], [(a + i[other]).tolist(), alphabet[c[other]].tolist()]
            keep(row, lambda w, i, c: w[:i] + chr(c) + w[i + 1 :])
            here = slice(a, min(a + step, length + 1))
            row, i, c = held((sums[:, here] + (whole - sums[:, here]) * _BASE)[:, :, None] + (alphabet * powers[here][:, None])[None])
            first = (a + i == 0) | (letters[row, np.maximum(a + i - 1, 0)] != alphabet[c])
            row, keys = row[first], [(a + i[first]).tolist(), alphabet[c[first]].tolist()]
            keep(row, lambda w, i, c: w[:i] + chr(c) + w[i:])
            if near:
                yield near, of


def _edited(alphabet: list[int], bits, least: int):
    letters = np.array(alphabet, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for near, of in edits(batch["word"].to_pylist(), letters, bits.value, least):
                yield arrow_batch(EDITS, near, of)

    return run


def variants(docs: DataFrame, least: int = LEAST, often: int = OFTEN, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    words = staged(vocabulary(docs, least, often), "words")
    alphabet = sorted(ord(x) for (x,) in words.select(F.explode(F.split("word", "")).alias("x")).where("x <> ''").distinct().collect())
    bits = spark.sparkContext.broadcast(vocabulary_filter(words))
    near = words.select("word").mapInArrow(_edited(alphabet, bits, least), EDITS)
    met = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    most = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near"))
    grouped = met.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), most.alias("most"))
    own = words.join(grouped, "word", "left")
    formed = F.col("most.near_n") >= times * F.col("n")
    own = staged(own.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("most.near")).alias("form"), F.when(formed, F.col("most.near_n")).alias("form_n")), "forms")
    roots = _jumped(own.where("form is not null").select(F.col("word").alias("id"), F.col("form").alias("c")), "roots")
    named = own.join(roots.select(F.col("id").alias("word"), F.col("c").alias("root")), "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op11_spelling_variants": op11_spelling_variants}
