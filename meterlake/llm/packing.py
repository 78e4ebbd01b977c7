"""Packing into optimal length buckets.

The histogram of all sequence lengths (one row per length, at most ``max_len``)
goes through a dynamic program that chooses the bucket boundaries with the least
padding; inside each bucket, batches are formed under a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import materialise, number_rows, text_of, words_of

SEED = 20


def best_boundaries(lengths: list[int], counts: list[int], n_buckets: int) -> list[int]:
    """Upper lengths of at most ``n_buckets`` buckets with the least total padding.

    ``lengths`` ascend.  cost[k][j]: least padding of the first j lengths in k
    buckets; the last bucket (i, j] pads every member to lengths[j - 1].
    """
    m = len(lengths)
    if not m:
        return []
    size = np.asarray(lengths, dtype=np.float64)
    rows = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    tokens = np.concatenate([[0.0], np.cumsum(size * counts)])
    cost = np.full(m + 1, np.inf)
    cost[0] = 0.0
    cuts = []
    for _ in range(min(n_buckets, m)):
        best, cut = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=np.int64)
        best[0] = 0.0
        for j in range(1, m + 1):
            padded = cost[:j] + size[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(padded))
            best[j] = padded[cut[j]]
        cost = best
        cuts.append(cut)
    bounds, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(cut[j])
    return bounds[::-1]


def sequences(docs: DataFrame, id_column: str, length: Column, max_len: int) -> DataFrame:
    """doc_id, piece, start, n_tokens: a document longer than ``max_len`` tokens
    is cut into pieces of ``max_len`` and one rest."""
    whole = docs.select(F.col(id_column).alias("doc_id"), F.greatest(length, F.lit(1)).cast("long").alias("all"))
    cut = whole.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("all") - 1) / max_len).cast("int"))))
    start = F.col("piece").cast("long") * max_len
    return cut.select("doc_id", "piece", start.alias("start"),
                      F.least(F.col("all") - start, F.lit(max_len)).cast("int").alias("n_tokens"))


def pack(docs: DataFrame, n_buckets: int = 8, max_len: int = 2048, token_budget: int = 16384,
         id_column: str = "doc_id", length: Column | None = None) -> DataFrame:
    """doc_id, piece, start, n_tokens, bucket, bucket_len, batch, slot, padding of
    every sequence.

    ``length``: a document's tokens; by default its words and one end mark (null
    and empty texts: the mark alone).  Pieces of one document are separate
    sequences.  A batch of a bucket has max(1, token_budget // bucket_len) rows,
    the last one of a bucket fewer; batches are numbered 0, 1, 2, ... in a bucket
    and rows are dealt to them in the order of a hash of (doc_id, piece).
    Repeated rows are packed one by one, null ids are allowed, other columns are
    ignored, an empty table gives an empty result.
    """
    if length is None:
        length = F.size(words_of(text_of())) + 1
    seqs = materialise(sequences(docs, id_column, length, max_len), "pack-lengths")
    # one row per length: at most max_len rows reach the driver
    histogram = sorted(seqs.groupBy("n_tokens").count().collect())
    bounds = best_boundaries([r[0] for r in histogram], [r[1] for r in histogram], n_buckets)
    bucket = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<int>"), lambda b: b < F.col("n_tokens")))
    bucketed = seqs.withColumn("bucket", bucket.cast("int"))
    upper = F.array(*[F.lit(b) for b in bounds]).cast("array<int>")
    numbered = number_rows(bucketed, "bucket", F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("piece")),
                           "index", ["doc_id", "piece", "n_tokens"])
    rows = F.greatest(F.floor(F.lit(token_budget) / F.col("bucket_len")), F.lit(1))
    return (numbered.withColumn("bucket_len", F.get(upper, F.col("bucket")))
            .withColumn("_rows", rows)
            .select("doc_id", "piece", "start", "n_tokens", "bucket", "bucket_len",
                    F.floor(F.col("index") / F.col("_rows")).cast("long").alias("batch"),
                    (F.col("index") % F.col("_rows")).cast("int").alias("slot"),
                    (F.col("bucket_len") - F.col("n_tokens")).alias("padding")))
