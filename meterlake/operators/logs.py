"""Log analysis: level counts and filtered first / last n lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The levels the log viewer knows.
LEVELS = ["INFO", "WARNING", "ERROR", "DEBUG"]


def log_level_counts(parsed: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Per level: lines *containing* the level name anywhere (a line can
    count for two levels) and lines whose parsed level equals it.  One pass."""
    aggs = []
    for lv in levels:
        aggs += [F.count_if(F.col("line").contains(lv)).alias(f"c_{lv}"),
                 F.count_if(F.col("level") == lv).alias(f"p_{lv}")]
    one = parsed.agg(*aggs)
    parts = [F.struct(F.lit(lv).alias("level"), F.col(f"c_{lv}").cast("long").alias("n_containing"),
                      F.col(f"p_{lv}").cast("long").alias("n_parsed")) for lv in levels]
    return one.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*")


def log_filter(lines: DataFrame, levels: Sequence[str] = ("INFO", "WARNING", "ERROR"),
               term: str | None = None) -> DataFrame:
    """Lines containing any of ``levels`` and, if given, ``term``
    (case-insensitive)."""
    cond = None
    for lv in levels:
        c = F.col("line").contains(lv)
        cond = c if cond is None else (cond | c)
    out = lines.where(cond) if cond is not None else lines.where(F.lit(False))
    if term:
        out = out.where(F.lower("line").contains(term.lower()))
    return out


def log_search(lines: DataFrame, levels: Sequence[str] = ("INFO", "WARNING", "ERROR"),
               term: str | None = None, n: int = 200, from_end: bool = True) -> DataFrame:
    """First or last ``n`` matching lines in file order (a distributed
    top-n on the line order, not a sort of the whole log)."""
    hits = log_filter(lines, levels, term)
    order = F.col("_ord").desc() if from_end else F.col("_ord").asc()
    return hits.orderBy(order).limit(n)
