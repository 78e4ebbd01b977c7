"""Join helpers: broadcast only behind a measured size bound, heavy keys split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.session import partitions_for, scratch_path

# A dimension bigger than this is joined by shuffle instead of broadcast.
DEFAULT_BROADCAST_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (a distributed count: no
    task gathers rows for it)."""
    return df.count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is proven small, ``df`` unchanged
    otherwise (the planner then picks a shuffle join; AQE may still convert
    it at runtime from real sizes)."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


# A key is heavy if it holds more rows than this share of a shuffle partition's.
HEAVY_SHARE = 0.5


def split_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner", max_broadcast: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join rows of ``many`` to ``few`` (a row or so per key) on ``key``.

    A small ``few`` is broadcast.  Else heavy keys are found by a count (partial sums,
    so a hot key is one row per map task) and split: their rows are dealt over as many
    salts as they fill partitions, and their row of ``few`` is repeated for each salt.
    ``many`` is written and read again for that, not made anew for each pass over it.
    All other keys keep the salt 0.  There can only be some two heavy keys for each
    partition, so their list is broadcast and the repeats are few.  Rows with a NULL
    key match nothing, as in any join; ``how`` is inner or left.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if row_count_at_most(few, max_broadcast):
        return many.join(F.broadcast(few), key, how)
    spark, path = many.sparkSession, scratch_path(many.sparkSession, "split")
    many.write.parquet(path)
    many = spark.read.schema(many.schema).parquet(path)
    total = many.count()
    parts = partitions_for(spark, total)
    counts = many.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    limit = max(1.0, HEAVY_SHARE * total / parts)
    heavy = counts.where(F.col("_n") > limit).select("_k", F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("_salts"))
    rows = heavy.collect()                               # at most parts / HEAVY_SHARE
    if not rows:
        return many.repartition(parts, key).join(few, key, how)
    heavy = F.broadcast(many.sparkSession.createDataFrame(rows, heavy.schema))
    # NULL keys match nothing: they are dealt out too, so that they don't meet in one task
    salts = F.when(F.col(key).isNull(), parts).otherwise(F.coalesce("_salts", F.lit(1)))
    dealt = many.join(heavy, F.col(key) == F.col("_k"), "left").withColumn(
        "_salt", F.pmod(F.monotonically_increasing_id(), salts).cast("int")).drop("_k", "_salts")
    repeated = few.join(heavy, F.col(key) == F.col("_k"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_k", "_salts")
    return dealt.repartition(parts, key, "_salt").join(repeated, [key, "_salt"], how).drop("_salt")
