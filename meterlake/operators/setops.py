"""Union by name, distinct values, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Concatenate frames aligning columns by name (missing ones NULL)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def distinct_values(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Distinct non-null values of ``column`` over several frames; each side
    is de-duplicated map-side before the shuffle."""
    parts = [f.select(column).where(f[column].isNotNull()) for f in frames]
    return union_by_name(parts).distinct()


def sample_rows(df: DataFrame, fraction: float, keys: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """The rows whose key hashes below ``fraction`` (the sampling *is* the feature here).

    A row stays or goes by its ``keys`` (default: all columns) and ``seed`` alone, so
    the sample is the same however the table is partitioned or ordered, rows of one
    key stay together, a smaller fraction is a subset of a larger one, and two tables
    sampled on the same key still join.  The hash is the first 13 hex digits of MD5
    over the seed and the values, which any SQL engine can compute."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in keys or df.columns]
    digest = F.md5(F.encode(F.concat_ws("\x1f", F.lit(str(seed)), *parts), "UTF-8"))
    # 52 bits, zero-padded: text order is number order
    bound = min(int(fraction * 16 ** 13), 16 ** 13 - 1)
    return df.where(F.substring(digest, 1, 13) < F.lit(f"{bound:013x}")) if fraction < 1 else df
