"""Periodic runs of words, by the method of Kolpakov and Kucherov, and texts with the repeats folded.

A run is a stretch of words with smallest period q and a length of at least ``max(least, times * q)`` that no neighbouring
word extends keeping that period. Per text:

1. Words become numbers. Stretches that can hold no run are put aside: each stretch of ``gram`` words of a run comes again
   within the run, so words that no such repeated gram covers are in no run and end none; what remains is
   cut at them and looked at again, stretch by stretch. This is exact, and leaves little of running text.
2. A suffix automaton of the stretch gives its Lempel-Ziv factors: each is the longest stretch that has begun before, with
   the place where it stood first, or a new word.
3. Main's algorithm finds the runs that touch a factor's start and end in that factor, from common prefixes and suffixes on both
   sides; with the previous factor's start at ``a`` and this one's end at ``e`` their periods are under ``(e - a) / (times - 1)``, and
   they start less than a period before ``a``.
4. All other runs lie strictly inside a factor; they are copied from where the factor stood before, left to right.

All time is linear in the text but for the sort of runs, of which there are few. Memory is in line with the longest text.

Edge cases: a null, empty or blank text has no words and no run; a null doc_id is kept and its text isn't rewritten; rows that repeat
a doc_id are each their own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from fractions import Fraction
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_batch

LEAST, TIMES = 6, 4
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """Suffix automaton of a sequence of whole numbers. Nearly all states have one way on, held in arrays; further ways are in dictionaries."""

    def __init__(self, word: list[int]):
        self.link, self.length, self.end = array("i", [-1]), array("i", [0]), array("i", [-1])
        self.letter, self.target, self.more = array("i", [-1]), array("i", [0]), {}
        last = 0
        for at, letter in enumerate(word):
            last = self._extended(last, letter, at)

    def go(self, state: int, letter: int) -> int:
        """The state after ``letter``, or 0 (which no way leads to)."""
        if self.letter[state] == letter:
            return self.target[state]
        return self.more[state].get(letter, 0) if state in self.more else 0

    def _set(self, state: int, letter: int, target: int) -> None:
        if self.letter[state] in (-1, letter):
            self.letter[state], self.target[state] = letter, target
        else:
            self.more.setdefault(state, {})[letter] = target

    def _state(self, length: int, end: int) -> int:
        for values, x in ((self.link, 0), (self.length, length), (self.end, end), (self.letter, -1), (self.target, 0)):
            values.append(x)
        return len(self.link) - 1

    def _extended(self, last: int, letter: int, at: int) -> int:
        new, state, old = self._state(self.length[last] + 1, at), last, 0
        while state != -1 and not (old := self.go(state, letter)):
            self._set(state, letter, new)
            state = self.link[state]
        if state == -1:
            return new
        if self.length[state] + 1 == self.length[old]:
            self.link[new] = old
            return new
        copy = self._state(self.length[state] + 1, self.end[old])
        self.letter[copy], self.target[copy], self.link[copy] = self.letter[old], self.target[old], self.link[old]
        if old in self.more:
            self.more[copy] = dict(self.more[old])
        while state != -1 and self.go(state, letter) == old:
            self._set(state, letter, copy)
            state = self.link[state]
        self.link[old] = self.link[new] = copy
        return new


def factors(word: list[int]) -> list[tuple[int, int, int]]:
    """(start, end, source) of the Lempel-Ziv factors; the source is where the factor stood first, -1 for a new letter."""
    automaton, found, at = Automaton(word), [], 0
    while at < len(word):
        state, here = 0, at
        while here < len(word):
            onward = automaton.go(state, word[here])
            if automaton.end[onward] >= here:
                break
            state, here = onward, here + 1
        found.append((at, max(here, at + 1), automaton.end[state] - (here - at) + 1 if here > at else -1))
        at = max(here, at + 1)
    return found


def _common(x: list[int], y: list[int], most: int) -> list[int]:
    """For i in 0..most-1, how much of ``x`` stands in ``y`` from i on (the Z function of x before y)."""
    own, out = [len(x)], []
    for z, text, start, end in ((own, x, 1, len(x)), (out, y, 0, min(most, len(y)))):
        left = right = 0
        for i in range(start, end):
            n = min(own[i - left], right - i) if i < right and i - left < len(own) else 0
            while n < len(x) and i + n < len(text) and x[n] == text[i + n]:
                n += 1
            if i + n > right:
                left, right = i, i + n
            z.append(n)
    return out + [0] * (most - len(out))


def _touching(word: list[int], a: int, b: int, e: int, times: int) -> Iterator[tuple[int, int, int]]:
    """Repetitions (start, end, period) of at least ``times`` periods that touch ``b`` and end by ``e``; the previous factor starts at ``a``."""
    most = (e - a) // (times - 1)
    if not most:
        return
    left = max(0, a - most)
    before, after = word[left:b][::-1], word[b:e]
    # Periods that stand whole after b: what the factor shares with itself p on, and the text before b with that before b + p.
    n = min(most, len(after))
    ahead = _common(after, after, n + 1)
    back = _common(before, word[left : b + n][::-1], n)
    found = [(b - back[n - p], b + p + ahead[p], p) for p in range(1, n + 1)]
    # Periods that stand whole before b.
    n = min(most, len(before))
    back = _common(before, before, n + 1)
    ahead = _common(after, word[b - n : e], n)
    found += [(b - p - back[p], b + ahead[n - p], p) for p in range(1, n + 1)]
    for start, end, period in found:
        if end - start >= times * period and not (start and word[start - 1] == word[start - 1 + period]) and not (end < len(word) and word[end] == word[end - period]):
            yield start, end, period


def runs(word: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs of ``word``, by start, then period."""
    word = [*word, -2]  # a letter of its own, so that the last factor ends before it
    parts, periods, starts = factors(word), {}, []

    def add(start: int, end: int, period: int) -> None:
        if end - start >= max(least, times * period) and periods.setdefault((start, end), period) >= period:
            if periods[start, end] == period and (start, end) not in seen:
                insort(starts, (start, end))
                seen.add((start, end))
            periods[start, end] = period

    seen: set[tuple[int, int]] = set()
    for (a, b, _), (_, e, _) in zip(parts, parts[1:]):
        for run in _touching(word, a, b, e, times):
            add(*run)
    for begin, stop, source in parts:
        if source < 0 or stop - begin < least + 2:
            continue
        at = bisect_right(starts, (source + 1, -1))
        while at < len(starts) and starts[at][0] < source + stop - begin:
            start, end = starts[at]
            if end < source + stop - begin:
                add(start + begin - source, end + begin - source, periods[start, end])
            at += 1
    return sorted((start, end - start, period) for (start, end), period in periods.items())


def stretches(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """(start, end) of stretches that hold all runs: made of grams that come again in their stretch."""
    gram = max(1, min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 1)))
    if len(ids) < least:
        return []
    code = np.zeros(len(ids) - gram + 1, np.uint64)
    for i in range(gram):
        code = (code + ids[i : i + len(code)].astype(np.uint64)) * _GOLD
        code ^= code >> np.uint64(29)
    places, group = np.arange(len(code)), np.zeros(len(code), np.uint64)
    while len(places):
        key = (code[places] + group) * _GOLD
        mask = (1 << int(8 * len(key)).bit_length()) - 1  # equal slots of unlike grams only keep more than is needed
        slot = ((key >> np.uint64(20)) & np.uint64(mask)).astype(np.int64)
        again = np.bincount(slot, minlength=mask + 1)[slot] > 1
        places = places[again]
        group = np.cumsum(np.diff(places, prepend=-9) != 1).astype(np.uint64)
        if again.all():
            break
    cuts = np.flatnonzero(np.diff(places, prepend=-9) != 1)
    ends = np.append(cuts[1:], len(places)) - 1
    return [(int(places[i]), int(places[j]) + gram) for i, j in zip(cuts, ends) if places[j] + gram - places[i] >= least]


def text_runs(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Runs of a whole text's word numbers."""
    found: list[tuple[int, int, int]] = []
    for start, end in stretches(ids, least, times):
        found += [(start + s, n, q) for s, n, q in runs(ids[start:end].tolist(), least, times)]
    return sorted(found)


def numbered(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(x, len(known)) for x in words), np.int64, len(words))


def planted(n: int, doc_id: int | None) -> np.ndarray:
    """Which original word stands at each of ``n`` places: in a tenth of the documents all from some place on repeat with a period."""
    order = np.arange(n)
    if doc_id is not None and n and (h := zlib.crc32(b"%d" % doc_id)) % 10 == 0:
        g = h // 10
        a = g % n
        order[a:] = a + (order[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return order


def folded(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay: those in no run after its first period."""
    kept = np.ones(n, bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return kept


RUNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _rows(rewritten: bool, least: int, times: int):
    def row(doc_id: int | None, text: str | None) -> tuple:
        words = (text or "").encode().split()
        if rewritten and words:
            order = planted(len(words), doc_id)
            words = [words[i] for i in order.tolist()]
        found = text_runs(numbered(words), least, times)
        most = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        best = (*most, 1000 * most[1] // most[2]) if most else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        left = b" ".join(compress(words, folded(len(words), found).tolist()) if found else words)
        return doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(i, x.as_py()) for i, x in zip(batch["doc_id"].to_pylist(), batch["text"])]
            if rows:
                yield arrow_batch(RUNS, *map(list, zip(*rows)))

    return run


def periodic_runs(docs: DataFrame, rewritten: bool = False, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): number of runs, the one of most periods, digests of all runs and of the folded text.

    ``rewritten`` plants a period in a tenth of the documents first, by their id.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(_rows(rewritten, least, times), RUNS)


def _folded_texts(column: str, least: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch[column]:
                text = x.as_py()
                words = (text or "").encode().split()
                found = text_runs(numbered(words), least, times)
                out.append(b" ".join(compress(words, folded(len(words), found).tolist())).decode() if found else text)
            at = batch.schema.get_field_index(column)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return run


def without_repeats(docs: DataFrame, column: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``docs`` with each run of ``column`` folded to its first period; texts without a run stay as they are, and so do all other columns."""
    return docs.mapInArrow(_folded_texts(column, least, times), docs.schema)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), rewritten=True)


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
