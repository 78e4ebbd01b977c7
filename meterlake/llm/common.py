"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import CLEANED, bytes_of, configured, scratch_path

SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = "[ \\t-\\r]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Spark sizes a table by its files and its columns: what an explode, a mapInPandas or a join
# makes of it may be many times as much.  So a table is broadcast only if ``small`` counted
# it, or if a shuffle has measured it: up to so many bytes, and no more than the session allows.
MEASURED_BYTES = 4 << 20
# Tables up to this many rows of bounded width may be broadcast.
BROADCAST_ROWS = 10_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _measured(spark: SparkSession) -> dict[str, int]:
    allowed = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    most = -1 if allowed.startswith("-") else min(bytes_of(spark, "spark.sql.autoBroadcastJoinThreshold"), MEASURED_BYTES)
    return {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.autoBroadcastJoinThreshold": most}


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: cuts
    the lineage, survives lost executors and is evaluated once.  What was shuffled
    for it is deleted as soon as it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with configured(spark, {**CLEANED, **_measured(spark)}):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, when nothing reads them any more."""
    for table in tables:
        discard(table.sparkSession, table._scratch)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``materialise`` or a like writer made, when nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    inner = F.trim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _SPACE_RUN))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where body
    refers to it inside further lambdas."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a materialised table of narrow rows) with a broadcast hint if it
    has at most ``rows`` rows; beyond that the planner shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def uniform(*parts: Column) -> Column:
    """Deterministic pseudo-random number in (0, 1) from a hash of ``parts``."""
    return ((F.xxhash64(*parts).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52)))


def search(value: Column, bounds: list[int]) -> Column:
    """Number of sorted ``bounds`` that are <= value: two levels of about
    sqrt(n) comparisons each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
    nested = F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks])
    block = F.size(F.filter(heads, lambda x: x <= value))
    inside = F.size(F.filter(F.element_at(nested, F.greatest(block, F.lit(1))), lambda x: x <= value))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + inside).cast("int")


def number_rows(df: DataFrame, group: str, order: Column, index: str, ties: list[str], bits: int = 10) -> DataFrame:
    """Add ``index``: 0, 1, 2, ... within each ``group`` in the order of the
    64-bit hash ``order``, then ``ties``.

    The hash's top bits cut every group into 2**bits ranges that are numbered
    apart and shifted by the rows before them, so that no task holds a group.
    ``df`` is evaluated twice: pass a materialised table with few groups.
    """
    from pyspark.sql import Window as W

    keyed = df.withColumn("_order", order).withColumn("_range", F.shiftrightunsigned("_order", 64 - bits).cast("int"))
    counts = keyed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select(F.col(group).alias("_group"), F.col("_range").alias("_r"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # unsigned order: flip the sign bit
    unsigned = F.col("_order").bitwiseXOR(F.lit(-(1 << 63)))
    inside = W.partitionBy(group, "_range").orderBy(unsigned, *ties)
    return (keyed.withColumn("_row", F.row_number().over(inside))
            .join(F.broadcast(shift), (F.col(group) == F.col("_group")) & (F.col("_range") == F.col("_r")))
            .withColumn(index, (F.col("_before") + F.col("_row") - 1).cast("long"))
            .drop("_order", "_range", "_row", "_group", "_r", "_before"))
