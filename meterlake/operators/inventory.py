"""Reports over file inventories: coverage, roll-ups, layout and compression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.sources.inventory import escape_glob

MB = 1024 * 1024


def source_coverage(inventory: DataFrame, silver: dict[str, DataFrame]) -> DataFrame:
    """Per discovered file: whether any silver row came from it.  A left
    join of the inventory with the distinct ``source_file`` values (one row
    per file, small)."""
    seen = None
    for kind, df in silver.items():
        s = df.select(F.lit(kind).alias("data_type"), "source_file").distinct()
        seen = s if seen is None else seen.unionByName(s)
    seen = seen.withColumn("covered", F.lit(True))
    j = inventory.join(seen, ["data_type", "source_file"], "left")
    return j.select("data_type", "division", "subdivision", "source_file", "path", "length",
                    F.coalesce(F.col("covered"), F.lit(False)).alias("covered"))


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """covered / total files per type, percent with a zero-file guard."""
    g = coverage.groupBy("data_type").agg(F.count(F.lit(1)).alias("n_files"),
                                          F.count_if("covered").alias("n_covered"))
    return g.select("data_type", "n_files", "n_covered",
                    F.when(F.col("n_files") > 0, F.round(F.col("n_covered") / F.col("n_files") * 100, 2))
                    .alias("pct_covered"))


def inventory_rollup(inventory: DataFrame) -> DataFrame:
    """Per (type, division): files, subdivisions, MB, and size statistics."""
    mb = F.col("length") / MB
    return inventory.groupBy("data_type", "division").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.count_distinct("subdivision").alias("n_subdivisions"),
        F.round(F.sum(mb), 3).alias("total_mb"), F.round(F.avg(mb), 3).alias("avg_mb"),
        F.round(F.min(mb), 3).alias("min_mb"), F.round(F.max(mb), 3).alias("max_mb"))


def layout_report(spark, paths: list[str]) -> DataFrame:
    """Parquet part files in ``paths`` (the folders of a committed version, taken
    literally; versions it replaced don't count): count and size per folder."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load([escape_glob(p) for p in paths]).select("path", "length"))
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(
        F.count(F.lit(1)).alias("n_parts"), F.sum("length").alias("bytes"),
        F.round(F.sum("length") / MB, 3).alias("mb"))


def compression_ratio(source_inventory: DataFrame, silver_layout: dict[str, DataFrame]) -> DataFrame:
    """Per type: bronze bytes, silver bytes and 1 - silver/bronze (true
    per-type sizes, not an even split of the source)."""
    src = source_inventory.groupBy("data_type").agg(F.sum("length").alias("source_bytes"))
    parts = None
    for kind, lay in silver_layout.items():
        s = lay.agg(F.sum("bytes").alias("silver_bytes")).select(F.lit(kind).alias("data_type"), "*")
        parts = s if parts is None else parts.unionByName(s)
    j = src.join(parts, "data_type", "inner")
    return j.select("data_type", "source_bytes", "silver_bytes",
                    F.when(F.col("source_bytes") > 0,
                           F.round((1 - F.col("silver_bytes") / F.col("source_bytes")) * 100, 2))
                    .alias("space_saved_pct"))
