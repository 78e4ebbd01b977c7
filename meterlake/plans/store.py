"""Silver tables in plain Parquet folders, switched by one commit row per load.

Layout under a target root::

    <target>/<kind>/v=<run_id>/_part=<yyyy-MM>/part-*.parquet   data of one load
    <target>/_manifest/<run_id>/                 the files loaded, as of that run
    <target>/_rejects/<run_id>/                  files the run could not read
    <target>/_commits/<run_id>/                  one row per table: its folders

Tables are partitioned by month (of ``billing_month`` / ``timestamp``).  A load
writes its data folders, then its manifest, then its commit rows in one file: that
is the only switch.  Readers take the newest commit row of a table and read exactly
the folders it lists, so an upsert rewrites the months it touches and lists the
others unchanged, and a failure before the commit changes nothing for anybody.

No older state is kept: the next load begins by deleting the folders that no
newest commit row lists (those a load replaced or left behind unfinished).  One
load per target may run at a time.  This is the least an atomic switch needs;
history, concurrent writers and compaction are a table format's work.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.clean import dedup_last
from meterlake.schemas import MANIFEST, SILVER
from meterlake.sources.inventory import decode_uri, escape_glob, path_missing

COMMITS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("paths", T.ArrayType(T.StringType())),
    T.StructField("n_files", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
])
REJECTS = "data_type string, path string, length long, modified timestamp, reason string, run_id string"

# Codecs accepted for silver Parquet.
CODECS = ("snappy", "gzip", "zstd", "lz4", "none", "uncompressed")


def new_run_id(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def check_codec(codec: str) -> str:
    c = codec.lower()
    if c not in CODECS:
        hint = " (brotli has no codec in this Spark build; zstd compresses as well)" if c == "brotli" else ""
        raise ValueError(f"unsupported Parquet compression {codec!r}{hint}; use one of {CODECS}")
    return c


@dataclass
class Version:
    run_id: str
    paths: list[str]
    committed_at: dt.datetime


def _read_runs(spark: SparkSession, folder: str, schema) -> DataFrame | None:
    """Rows of all runs below ``folder``, None if it does not exist.  Any other
    failure is raised."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(escape_glob(folder))
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return None


def commits(spark: SparkSession, target: str) -> DataFrame | None:
    """Commit rows of the target (a few per load), None before its first commit."""
    return _read_runs(spark, f"{target.rstrip('/')}/_commits", COMMITS)


def latest_versions(spark: SparkSession, target: str) -> dict[str, Version]:
    """Newest committed version of every table (one small job)."""
    c = commits(spark, target)
    if c is None:
        return {}
    rows = dedup_last(c, ["data_type"], ["committed_at", "run_id"]).collect()   # one per table
    return {r["data_type"]: Version(r["run_id"], list(r["paths"]), r["committed_at"]) for r in rows}


def latest_version(spark: SparkSession, target: str, kind: str) -> Version | None:
    return latest_versions(spark, target).get(kind)


def delete(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _run_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders directly below ``folder`` (one per load that is still there)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().toString() for x in fs.listStatus(p)] if fs.exists(p) else []


def drop_unlisted(spark: SparkSession, target: str, versions: dict[str, Version], kinds) -> None:
    """Delete what no newest commit row needs: data folders of replaced or unfinished
    loads, their staged batches and older manifests."""
    root = target.rstrip("/")
    listed = {p.rsplit("/", 1)[0].rsplit("/", 1)[-1] for v in versions.values() for p in v.paths}
    newest = max(versions.values(), key=lambda v: (v.committed_at, v.run_id)).run_id if versions else None
    for kind in kinds:
        for f in _run_folders(spark, f"{root}/{kind}"):
            if f.rsplit("/", 1)[-1] not in listed:
                delete(spark, f)
    for f in _run_folders(spark, f"{root}/_manifest"):
        if f.rsplit("/", 1)[-1] != newest:
            delete(spark, f)
    delete(spark, f"{root}/_staging")


def data_path(target: str, kind: str, run_id: str) -> str:
    return f"{target.rstrip('/')}/{kind}/v={run_id}"


# Month partition of each table (text, ``__null__`` when the time is NULL).
PART_COL = "_part"
PART_SOURCE = {"bills": "billing_month", "readings": "timestamp"}
# readings: the partition is a function of the key (timestamp, meter), so a
# key can never sit in two partitions
PART_IN_KEY = {"bills": False, "readings": True}


def part_value(kind: str):
    return F.coalesce(F.date_format(PART_SOURCE[kind], "yyyy-MM"), F.lit("__null__"))


def read_dirs(spark: SparkSession, dirs: list[str], kind: str) -> DataFrame:
    """Rows of the given partition folders (taken literally, not as globs)."""
    if not dirs:
        return spark.createDataFrame([], SILVER[kind])
    return (spark.read.schema(SILVER[kind]).option("recursiveFileLookup", "true")
            .parquet(*[escape_glob(d) for d in dirs]))


def read_version(spark: SparkSession, version: Version, kind: str) -> DataFrame:
    return read_dirs(spark, version.paths, kind)


def write_table(df: DataFrame, out: str, kind: str, codec: str) -> list[str]:
    """Write ``df`` month-partitioned under ``out``; return the partition
    folders written (a metadata listing, one row per file)."""
    # Rebalance on the month: AQE packs each month into few ~advisory-size
    # files and splits a hot month over several tasks (no giant task, no
    # thousands of tiny files from every task writing every month).
    # Within each task rows are then sorted by (month, meter, time): one local
    # sort that also satisfies the partitioned writer, clusters a meter's rows
    # for dictionary / run-length encoding and gives row groups tight meter
    # ranges, so a meter filter skips most of them.
    (df.withColumn(PART_COL, part_value(kind)).hint("rebalance", PART_COL)
     .sortWithinPartitions(PART_COL, "meter_id", PART_SOURCE[kind])
     .write.mode("errorifexists").option("compression", codec).partitionBy(PART_COL).parquet(out))
    return partition_dirs(df.sparkSession, out)


def partition_dirs(spark: SparkSession, out: str) -> list[str]:
    try:
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .load(f"{escape_glob(out.rstrip('/'))}/{PART_COL}=*").select("path"))
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return []                       # an empty batch: no partition folder
    d = F.regexp_replace(decode_uri(F.col("path")), "/[^/]*$", "")
    return sorted(r[0] for r in files.select(d.alias("d")).distinct().collect())


def dir_part(path: str) -> str:
    """Partition value of a partition folder path (as written by Spark)."""
    return unquote(path.rstrip("/").rsplit("/", 1)[-1].split("=", 1)[1])


def write_manifest(spark: SparkSession, target: str, rows: DataFrame, run_id: str, replaced: list[str]) -> None:
    """The files loaded as of this run: ``rows`` (the files it read) over the rows of the
    newest committed manifest; tables in ``replaced`` are not carried over."""
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in MANIFEST.fields])
    old = committed_manifest(spark, target).where(~F.col("data_type").isin(replaced))
    dedup_last(old.unionByName(rows), ["data_type", "path"], ["committed_at", "run_id"]).write.mode("errorifexists").parquet(
        f"{target.rstrip('/')}/_manifest/{run_id}")


def commit(spark: SparkSession, target: str, run_id: str, mode: str,
           tables: dict[str, tuple[list[str], int]], at: dt.datetime) -> None:
    """One commit file for all tables of a run: they switch together."""
    rows = [(run_id, kind, mode, paths, int(n), at.replace(tzinfo=None)) for kind, (paths, n) in tables.items()]
    spark.createDataFrame(rows, COMMITS).coalesce(1).write.mode("errorifexists").parquet(
        f"{target.rstrip('/')}/_commits/{run_id}")


def committed_manifest(spark: SparkSession, target: str) -> DataFrame:
    """One row per file of the committed tables: what was read of it and when."""
    versions = latest_versions(spark, target)
    if not versions:
        return spark.createDataFrame([], MANIFEST)
    newest = max(versions.values(), key=lambda v: (v.committed_at, v.run_id)).run_id
    # every committed run wrote its manifest first: a missing folder is an error
    return spark.read.schema(MANIFEST).parquet(escape_glob(f"{target.rstrip('/')}/_manifest/{newest}"))


def write_rejects(spark: SparkSession, target: str, rows: DataFrame, run_id: str) -> None:
    rows.withColumn("run_id", F.lit(run_id)).select(*[c.split()[0] for c in REJECTS.split(", ")]).write.mode(
        "errorifexists").parquet(f"{target.rstrip('/')}/_rejects/{run_id}")


def load_rejects(spark: SparkSession, target: str, run_id: str | None = None) -> DataFrame:
    """Files that a load (of ``run_id``; else any) could not read, and why.  They are
    not in the manifest, so every later load tries them again."""
    rows = _read_runs(spark, f"{target.rstrip('/')}/_rejects", REJECTS)
    if rows is None:
        return spark.createDataFrame([], REJECTS)
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)
