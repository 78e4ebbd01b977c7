"""Statistics of a loaded target: rows, distincts, time range, size on
storage and the last full / incremental / append load (from the commit log)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.reports import table_statistics
from meterlake.plans import store
from meterlake.sources.inventory import escape_glob

MB = 1024 * 1024


def load_statistics(spark: SparkSession, target: str) -> DataFrame:
    versions = store.latest_versions(spark, target)
    commits = store.commits(spark, target)
    if not versions or commits is None:
        return spark.createDataFrame(
            [], "table_name string, n_rows long, n_meters long, n_divisions long, "
                "n_subdivisions long, min_time string, max_time string, size_mb double, "
                "n_parts long, version string, last_full_load timestamp, "
                "last_incremental_load timestamp, last_append_load timestamp")
    parts = []
    for kind, v in sorted(versions.items()):
        df = store.read_version(spark, v, kind)
        stats = table_statistics(df, kind, store.PART_SOURCE[kind])
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load([escape_glob(x) for x in v.paths])
                 .select("length"))
        size = files.agg(F.sum("length").alias("b"), F.count(F.lit(1)).alias("n")).collect()[0]
        parts.append(stats.select(
            "*", F.lit(round((size["b"] or 0) / MB, 3)).alias("size_mb"),
            F.lit(int(size["n"])).cast("long").alias("n_parts"), F.lit(v.run_id).alias("version")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    last = commits.groupBy(F.col("data_type").alias("table_name")).agg(
        *[F.max(F.when(F.col("mode") == m, F.col("committed_at"))).alias(f"last_{m}_load")
          for m in ("full", "incremental", "append")])
    return out.join(last, "table_name", "left")
