"""Toxicity: a character n-gram linear classifier with naive Bayes scaling.

A feature is a hashed n-gram of characters, present or not.  Its value is the
naive Bayes log-count ratio of the labelled texts, and a logistic regression over
these values is trained on them.  Texts are scored whole in numpy batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = (3, 4, 5)
BITS = 18
# Bound of the labelled rows that are learned from: so many of each class, the
# first in the order of a hash of the id.
SAMPLE_PER_CLASS = 6000
# Buckets that the classifier uses: those whose log-count ratio is surest.
FEATURES = 8192
THRESHOLD = 0.3
SEED = 7
# Characters hashed at once: bounds a task's memory.
BLOCK = 1 << 21

_MULTIPLY, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def fold(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-32-le", "surrogatepass")


def positions(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct buckets of each text, by row; with
    ``wanted`` (a flag per bucket) only of those."""
    found = [np.empty(0, dtype=np.int64)]
    for first, chars, rows in _blocks(texts):
        gram = chars.copy()
        for n in range(2, max(ORDERS) + 1):
            if len(gram) < 2:
                break
            gram = gram[:-1] * _MULTIPLY + chars[n - 1:]
            if n not in ORDERS:
                continue
            bucket = ((gram * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)
            keep = rows[n - 1:] == rows[:len(bucket)]  # within one text
            if wanted is not None:
                keep &= wanted[bucket]
            at = np.flatnonzero(keep)
            found.append(np.unique(((rows[at] + first) << BITS) | bucket[at]))
    pairs = np.unique(np.concatenate(found))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``BLOCK`` characters; a longer text is cut into
    blocks that overlap by the longest n-gram less one."""
    held, size, first = [], 0, 0
    for k, text in enumerate(texts):
        chars = np.frombuffer(fold(text), dtype="<u4")
        if size and size + len(chars) > BLOCK:
            yield first, *_joined(held)
            held, size = [], 0
        if not held:
            first = k
        if len(chars) > BLOCK:
            for at in range(0, len(chars), BLOCK):
                yield k, *_joined([chars[at:at + BLOCK + max(ORDERS) - 1]])
            held, size = [], 0
            continue
        held.append(chars)
        size += len(chars)
    if held:
        yield first, *_joined(held)


def _joined(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(held).astype(np.uint64), np.repeat(np.arange(len(held)), [len(x) for x in held])


@dataclass(frozen=True)
class Model:
    """weights: value of each bucket's presence (ratio times coefficient)."""
    bias: float
    weights: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows, buckets = positions(texts, self.weights != 0)
        total = self.bias + np.bincount(rows, weights=self.weights[buckets], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -50, 50)))


def in_training(doc_id: Column) -> Column:
    """The rows to learn from: crc32 of the id as text, mod 4, is not 2."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 != 2, F.lit(False))


def labelled_sample(labels: DataFrame, train: Column, per_class: int) -> DataFrame:
    """id, label (0 or 1) of at most ``per_class`` rows of each class."""
    known = (labels.filter(train & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("_label"))
             .withColumn("_order", F.xxhash64(F.lit(SEED), "_id")))
    parts = [known.filter(F.col("_label") == k).orderBy("_order", "_id").limit(per_class) for k in (0, 1)]
    return parts[0].union(parts[1]).select("_id", "_label")


def _count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for part in parts:
        rows, buckets = positions(part["text"].tolist())
        labels = part["_label"].to_numpy()[rows]
        for k in (0, 1):
            counts[k] += np.bincount(buckets[labels == k], minlength=1 << BITS)
    at = np.flatnonzero(counts.any(axis=0))
    yield pd.DataFrame({"bucket": at, "n0": counts[0, at], "n1": counts[1, at]})


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          per_class: int = SAMPLE_PER_CLASS, features: int = FEATURES) -> Model:
    """Learn from at most ``per_class`` labelled texts of either class (the rows
    of ``in_training``); class weights restore the classes' shares among all such
    labels.  Without both classes the score is the share of label 1 (0 if none)."""
    rule = in_training(F.col("doc_id"))
    shares = {r[0]: r[1] for r in labels.filter(rule & F.col("toxic").isNotNull())
              .groupBy(F.col("toxic").cast("int")).count().collect()}
    everything = sum(shares.values())
    sample = labelled_sample(labels, rule, per_class)
    texts = (docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
             .join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).select("text", "_label"))  # 2 * per_class rows

    # one row per bucket reaches the driver: at most 2 ** BITS
    counted = (texts.mapInPandas(_count, "bucket long, n0 long, n1 long").groupBy("bucket")
               .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas())
    n0, n1 = np.zeros(1 << BITS), np.zeros(1 << BITS)
    n0[counted["bucket"]], n1[counted["bucket"]] = counted["n0"], counted["n1"]
    if not n0.any() or not n1.any():
        share = shares.get(1, 0) / everything if everything else 0.0
        return Model(float(np.log((share + 1e-9) / (1 - share + 1e-9))), np.zeros(1 << BITS))
    ratio = np.log((1 + n1) / (1 + n1).sum()) - np.log((1 + n0) / (1 + n0).sum())
    sure = np.abs(ratio) / np.sqrt(1 / (1 + n1) + 1 / (1 + n0))
    chosen = np.sort(np.argsort(-sure, kind="stable")[:features])
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[chosen] = True
    place = np.zeros(1 << BITS, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))

    def rows_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows, buckets = positions(part["text"].tolist(), wanted)
            cuts = np.searchsorted(rows, np.arange(len(part) + 1))
            used = place[buckets].astype("<u2")
            yield pd.DataFrame({"label": part["_label"], "used": [
                used[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})

    # at most 2 * per_class rows of 2 * features bytes
    rows = texts.mapInPandas(rows_of, "label int, used binary").toPandas()
    bias, coefficients = _regression(rows["used"].tolist(), rows["label"].to_numpy(dtype=float), ratio[chosen],
                                     shares.get(1, 0) / everything)
    weights = np.zeros(1 << BITS)
    weights[chosen] = coefficients * ratio[chosen]
    return Model(bias, weights)


def _regression(used: list[bytes], labels: np.ndarray, ratio: np.ndarray, share: float,
                steps: int = 150, penalty: float = 1e-4) -> tuple[float, np.ndarray]:
    """Logistic regression on presence times ratio (Adam, all rows each step)."""
    order = np.argsort([bytes(x) for x in used], kind="stable") if len(used) else []
    used, labels = [used[i] for i in order], labels[order]  # the same sums in whatever order rows came
    lengths = np.array([len(x) // 2 for x in used])
    index = np.frombuffer(b"".join(used), dtype="<u2").astype(np.int64)
    row = np.repeat(np.arange(len(used)), lengths)
    weight = np.where(labels == 1, share / max(labels.mean(), 1e-9), (1 - share) / max(1 - labels.mean(), 1e-9))
    weight /= weight.sum()
    # scale a row by its number of features, so that long texts weigh as short ones do in training
    w, b = np.full(len(ratio), 0.05), np.log((share + 1e-6) / (1 - share + 1e-6))
    m, v = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for t in range(1, steps + 1):
        z = b + np.bincount(row, weights=(w * ratio)[index], minlength=len(used))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels)
        gradient = np.append(np.bincount(index, weights=error[row], minlength=len(ratio)) * ratio + penalty * w, error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        step = 0.02 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return float(b), w


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Every row of ``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score
    >= threshold, else 0) beside its columns; columns of these names are replaced.

    Null and empty texts have no features: their score is the bias alone, about
    the share of label 1.  Texts are scored whole, whatever their length.
    """
    held = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights.astype(np.float32)))  # 2 ** BITS floats

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bias, weights = held.value
        own = Model(bias, weights.astype(np.float64))
        for part in parts:
            yield pd.Series(own.score(part.tolist()))

    plain = docs.drop("score", "predicted")
    return (plain.withColumn("score", scored(F.col(text_column).cast("string")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def held_out_id(doc_id: object) -> bool:
    """As ``in_training`` says it, for one id outside Spark."""
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
