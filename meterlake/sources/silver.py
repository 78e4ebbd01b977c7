"""Silver scans: the committed table, a plain Parquet path, a tolerant scan."""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.joins import maybe_broadcast
from meterlake.plans import store
from meterlake.schemas import SILVER
from meterlake.session import scratch_path
from meterlake.sources.inventory import decode_uri

# The footer reader runs on executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scan_silver(spark: SparkSession, target: str, kind: str,
                start: str | None = None, end: str | None = None) -> DataFrame:
    """The newest committed version of ``kind`` under ``target``; falls back
    to reading ``target`` itself as a Parquet file or folder of parts.

    ``start`` / ``end`` (``yyyy-MM-dd[ HH:mm:ss]``, end exclusive) restrict
    the time column: month folders outside the range are not even listed
    (partition pruning), and the row filter reaches the Parquet reader."""
    v = store.latest_version(spark, target, kind)
    if v is None:
        df = spark.read.schema(SILVER[kind]).parquet(target)
    else:
        if start is not None or end is not None:
            lo = start[:7] if start else None
            hi = end[:7] if end else None
            # an exclusive end at a month's first instant excludes that month
            hi_open = end is not None and end[7:].strip() in ("-01", "-01 00:00:00", "-01 00:00")
            keep = [p for p in v.paths
                    if store.dir_part(p) != "__null__"
                    and (lo is None or store.dir_part(p) >= lo)
                    and (hi is None or store.dir_part(p) < hi or (store.dir_part(p) == hi and not hi_open))]
            v = store.Version(v.run_id, keep, v.committed_at)
        df = store.read_version(spark, v, kind)
    col = F.col(store.PART_SOURCE[kind])
    if start is not None:
        df = df.where(col >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(col < F.lit(end).cast("timestamp"))
    return df


@dataclass
class TolerantScan:
    data: DataFrame
    skipped: DataFrame      # path, rows_read, rows_expected (NULL: no readable footer)


def _footer_rows(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pdfs:
        found = []
        for content in pdf["content"]:
            try:
                found.append(pq.ParquetFile(io.BytesIO(content)).metadata.num_rows)
            except Exception:  # noqa: BLE001 - whatever is wrong with it, it is no Parquet part
                found.append(None)
        yield pd.DataFrame({"path": pdf["path"], "rows_expected": pd.array(found, dtype="Int64")})


def scan_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> TolerantScan:
    """Every whole Parquet part under ``path``; a part that is damaged anywhere is left
    out with all its rows and reported.  Raises when no part is whole.

    Three distributed looks, all with damaged parts tolerated: the rows that each
    footer promises (a scan without columns reads only footers), the rows that
    decoding every column gives (page checksums verified), and, for parts of which
    neither gives a row, the footer itself: a valid empty part is whole."""
    reader = (spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
              .option("parquet.page.verify-checksum.enabled", "true"))
    file = decode_uri(F.col("_metadata.file_path"))
    parts = reader.parquet(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    promised = parts.groupBy(file.alias("p")).agg(F.count(F.lit(1)).alias("promised"))
    decoded = parts.groupBy(file.alias("d")).agg(F.count(F.lit(1)).alias("rows_read"), F.bit_xor(F.xxhash64(*schema.names)).alias("_all"))
    seen = (listed.select(decode_uri(F.col("path")).alias("path")).join(promised, F.col("path") == F.col("p"), "left")
            .join(decoded, F.col("path") == F.col("d"), "left"))
    found = scratch_path(spark, "parts")
    seen.select("path", "promised", F.when(F.col("_all").isNotNull(), F.col("rows_read")).alias("rows_read")).write.parquet(found)
    seen = spark.read.parquet(found)
    blank = seen.where(F.col("promised").isNull()).select(F.col("path").alias("b"))
    footers = (listed.select(decode_uri(F.col("path")).alias("path"), "content").join(blank, F.col("path") == F.col("b"))
               .select("path", "content").mapInPandas(_footer_rows, "path string, rows_expected long"))
    empty = scratch_path(spark, "footers")
    footers.write.parquet(empty)
    footers = spark.read.schema("path string, rows_expected long").parquet(empty)
    short = seen.where(F.coalesce("rows_read", F.lit(0)) < F.col("promised")).select(
        "path", F.coalesce("rows_read", F.lit(0)).alias("rows_read"), F.col("promised").alias("rows_expected"))
    skipped = short.union(footers.where("rows_expected IS NULL OR rows_expected > 0").select("path", F.lit(0).cast("long"), "rows_expected"))
    if seen.join(skipped, "path", "left_anti").isEmpty():
        raise ValueError(f"no whole Parquet part under {path}; skipped {skipped.count()}")
    bad = skipped.select(F.col("path").alias("_bad"))
    data = parts.withColumn("_file", file).join(maybe_broadcast(bad), F.col("_file") == F.col("_bad"), "left_anti").drop("_file")
    return TolerantScan(data, skipped)


def preview(df: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a deterministic order (a top-n, not a full sort)."""
    order = order or df.columns[:1]
    return df.orderBy(*order).limit(n)
