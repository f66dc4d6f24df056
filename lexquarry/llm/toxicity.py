"""Toxicity: a linear classifier on character n-grams, features scaled by log-count ratios.

Features are the distinct character n-grams (of ``ORDERS`` sizes) of a text in lower case with
white space as one space, hashed to ``BUCKETS``. Naive Bayes log-count ratios of the two labels
scale the features (those of a ratio under ``LEAST_RATIO`` or in fewer than three rows are left
out); a logistic regression with an L2 penalty is fitted on the scaled features.

The fit takes a bounded, documented sample: ``SAMPLE`` labelled rows a class at most, those of
least hash, so the same at every run. What reaches the driver is a row's features, in ``BUCKETS`` bits
at most. Scoring covers every row and whole texts.

Edge cases: null or empty texts and those of white space have no n-gram and get the score of the intercept, as does
every text where no labelled row can be learned from one of the classes (then 0.5 or the one class's
side); labels of unknown or null doc_id count for nothing; doc_ids with several labels are toxic if
any says so, and are learned from by the least of their texts; a text shorter than an n-gram is one as a whole; repeated rows get equal scores; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import arrow_batch

ORDERS = (5,)
BUCKETS = 1 << 18
SAMPLE = 1500
HELD_OUT_OF = 5
PENALTY, ROUNDS, SMOOTHING, LEAST_RATIO = 3e-3, 80, 1.0, 0.7


def _chars(text: str | None) -> np.ndarray:
    """Code points of the text in lower case, white space as one space."""
    return np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le", "surrogatepass"), "<u4")


def features(text: str | None) -> np.ndarray:
    """Distinct hashed n-grams of a whole text; empty for a text without letters."""
    raw = _chars(text)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    found = []
    for n in ORDERS:
        n = min(n, len(raw))
        wide, code = raw.astype(np.uint64), np.zeros(len(raw) - n + 1, np.uint64)
        for i in range(n):
            code *= np.uint64(0x110001)
            code += wide[i : len(raw) - n + 1 + i]
        code *= np.uint64(0x9E3779B97F4A7C15)
        code >>= np.uint64(64 - BUCKETS.bit_length() + 1)
        found.append(code.astype(np.int64))
    codes = np.concatenate(found)
    place = np.arange(len(codes), dtype=np.int32)
    _LAST[codes] = place  # of equal codes the last one's place stays
    return codes[_LAST[codes] == place]


#: Scratch of ``features``: the place of each bucket's last n-gram in the text at hand.
_LAST = np.zeros(BUCKETS, np.int32)


def _packed(found: np.ndarray) -> bytes:
    """Features as 32-bit numbers, or as a bitmap where that is shorter."""
    if len(found) < BUCKETS // 32:
        return np.sort(found).astype("<i4").tobytes()
    marks = np.zeros(BUCKETS, bool)
    marks[found] = True
    return np.packbits(marks).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if len(data) < BUCKETS // 8:
        return np.frombuffer(data, "<i4")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8))).astype(np.int32)


def _marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), 200):
            some = batch.iloc[start : start + 200]
            yield pd.DataFrame({"toxic": some["toxic"].to_numpy(), "marks": [_packed(features(x)) for x in some["text"]]})


class Model:
    """Weight of each bucket and the intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def scores(self, texts) -> np.ndarray:
        sums = np.array([float(self.weights[features(x)].sum(dtype=np.float64)) for x in texts])
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -40, 40)))


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Log-count ratios, then full-batch gradient steps with momentum on the scaled features."""
    labels = np.asarray(labels, np.float64)
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS), 0.0 if not len(labels) else 4.0 * (2 * labels[0] - 1))
    counts = np.full((2, BUCKETS), SMOOTHING)
    for row, label in zip(rows, labels, strict=True):
        counts[int(label), row] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[(counts[0] + counts[1] < 2 * SMOOTHING + 3) | (abs(ratio) < LEAST_RATIO)] = 0
    used = np.flatnonzero(ratio)
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    kept = [row[ratio[row] != 0] for row in rows]
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in kept])
    at, scale = place[np.concatenate(kept)], ratio[used]
    weights, bias, step = np.zeros(len(used)), 0.0, np.zeros(len(used))
    share = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(labels)
    reach = np.sqrt(np.bincount(owner, weights=scale[at] ** 2, minlength=len(rows)).mean() + 1)
    bias_step = 0.0
    for _ in range(ROUNDS):
        z = np.bincount(owner, weights=(weights * scale)[at], minlength=len(rows)) + bias
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * share
        slope = np.bincount(at, weights=error[owner], minlength=len(used)) * scale + PENALTY / reach * weights
        step = 0.9 * step - 4 / reach * slope
        bias_step = 0.9 * bias_step - 0.5 * error.sum()
        weights, bias = weights + step, bias + bias_step
    out = np.zeros(BUCKETS)
    out[used] = weights * scale
    return Model(out, bias)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows a class of those labels whose fold is not held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.where(F.expr(f"crc32(cast(cast(doc_id as string) as binary)) % {HELD_OUT_OF} <> 0"))
    order = F.xxhash64("doc_id"), "doc_id"
    picked = known.where("toxic = 1").orderBy(*order).limit(sample).unionByName(known.where("toxic = 0").orderBy(*order).limit(sample))
    # At most 2 * sample rows of two numbers, whatever the corpus.
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(picked), "doc_id")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = texts.mapInPandas(_marks, "toxic int, marks binary").collect()  # a row of ``picked`` each at most
    found = sorted((bytes(r["marks"]), r["toxic"]) for r in rows)
    return fit([_unpacked(x) for x, _ in found], np.array([y for _, y in found]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield arrow_batch("doc_id long, score double", batch["doc_id"], model.scores(x.as_py() for x in batch["text"]))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with all their columns."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return docs.where(scored(F.col("text").cast("string")) < threshold)


def op8_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    scored = score(docs, train(docs, labels))
    return scored.select(
        "doc_id",
        F.expr(f"crc32(cast(cast(doc_id as string) as binary)) % {HELD_OUT_OF} = 0").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {"op8_toxicity_scores": op8_toxicity_scores}
