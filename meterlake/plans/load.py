"""Full, incremental and append loads of a bronze tree into silver tables.

full         every file of the tree -> clean -> new version (replaces).
incremental  only files new or changed since the last committed manifest
             (compared on path, length and modification time) -> clean ->
             upsert into the current version: a key present in the new batch
             replaces the stored row; stored keys absent from it are kept.
append       only files never loaded before -> clean -> added as one more
             folder of the current version (no cross-batch de-duplication).

A file that cannot be read (its header line fails, or lacks a column that every
valid row needs) does not stop a load: the others are loaded, the file is listed in
the run's rejects and not in the manifest, so the next load tries it again
(``strict=True`` raises instead).

Every load writes its data, then the manifest of the files read, and commits
last (see :mod:`meterlake.plans.store`).  An incremental load first stages the
cleaned batch as Parquet in the target: that cuts lineage, and the batch is
then read three times cheaply (its months, its keys, the merge).

The upsert rewrites only the month partitions it touches, and does *not*
shuffle the stored rows when the batch is small: the batch's keys are
broadcast (behind a row-count check) and stored rows are anti-joined
map-side; only a large batch falls back to a shuffle anti-join.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import clean
from meterlake.operators.joins import maybe_broadcast
from meterlake.plans import store
from meterlake.schemas import KINDS, SILVER
from meterlake.session import sized
from meterlake.sources.bronze import UnreadableHeader, file_headers, read_bronze, rejected, vanished, without
from meterlake.sources.inventory import INVENTORY, decode_uri, escape_glob, file_inventory

log = logging.getLogger("meterlake.load")


@contextmanager
def _step(name: str):
    t0 = time.perf_counter()
    yield
    log.debug("%s: %.3fs", name, time.perf_counter() - t0)


# Keys of a batch up to this many rows are broadcast for the upsert.
MERGE_BROADCAST_ROWS = 2_000_000
# Bytes of a row of a bronze file, about: they tell a load's shuffle partitions.
ROW_BYTES = 80
# Up to this many keys, the collision scan pushes them into the scan as IN.
KEY_LIST_MAX = 1_000

CLEANERS = {"bills": clean.clean_bills, "readings": clean.clean_readings}


@dataclass
class LoadResult:
    run_id: str
    mode: str
    tables: dict[str, dict] = field(default_factory=dict)
    rejected: int = 0        # files that could not be read (see store.load_rejects)


def frozen_inventory(spark: SparkSession, source: str, kinds: Sequence[str], layout: str) -> DataFrame:
    """List the tree once and pin the file set of this run (file metadata
    only), so the manifest records exactly what was read."""
    rows = file_inventory(spark, source, kinds, layout).collect()
    return spark.createDataFrame(rows, INVENTORY)


def changed_files(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are new, or whose (length, modified) differs from the last
    committed manifest row of the same path."""
    seen = manifest.select("data_type", "path", "length", "modified")
    return inventory.join(seen, ["data_type", "path", "length", "modified"], "left_anti")


def new_files(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    return inventory.join(manifest.select("data_type", "path"), ["data_type", "path"], "left_anti")


def upsert(existing: DataFrame, batch: DataFrame, keys: Sequence[str],
           broadcast_rows: int = MERGE_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``batch`` plus the rows of ``existing`` whose key is not in
    ``batch`` (NULL keys compare equal).  ``batch`` is unique per key."""
    bkeys = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    cond = [existing[k].eqNullSafe(bkeys[f"_k_{k}"]) for k in keys]
    kept = existing.join(maybe_broadcast(bkeys, broadcast_rows), cond, "left_anti")
    return kept.unionByName(batch)


def _dirs_where(spark: SparkSession, kind: str, dirs: list[str], hit_fn) -> set[str]:
    """Partition folders among ``dirs`` holding a row for which ``hit_fn``
    (stored rows -> filtered rows) keeps something; scans only the columns
    ``hit_fn`` uses."""
    stored = store.read_dirs(spark, dirs, kind).withColumn("_f", F.col("_metadata.file_path"))
    hit = hit_fn(stored)
    found = {r[0] for r in hit.select(F.regexp_replace(decode_uri(F.col("_f")), "/[^/]*$", ""))
             .distinct().collect()}
    norm = {p.rstrip("/").split(":", 1)[-1].lstrip("/"): p for p in dirs}
    return {norm[k] for k in (d.rstrip("/").split(":", 1)[-1].lstrip("/") for d in found) if k in norm}


def upsert_partitions(spark: SparkSession, current: store.Version, staged: DataFrame, kind: str,
                      out: str, codec: str, replaced_sources: DataFrame | None = None) -> list[str]:
    """Upsert ``staged`` into ``current`` rewriting only touched partitions.

    Touched = months present in the batch, plus (when the partition is not a
    function of the key) months where a stored row has a key of the batch -
    found by a scan of the key columns only.  With ``replaced_sources`` (a
    frame of ``source_file`` values) stored rows that came from those files
    are dropped first, so rows deleted from a changed file disappear.
    Returns the new version's partition folders."""
    keys = KINDS[kind]["key"]
    batch_parts = {r[0] for r in staged.select(store.part_value(kind)).distinct().collect()}
    # after an append a month has several folders
    touched = {p for p in current.paths if store.dir_part(p) in batch_parts}
    untouched = [p for p in current.paths if p not in touched]
    if not store.PART_IN_KEY[kind] and untouched:
        bkeys = staged.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        few = bkeys.limit(KEY_LIST_MAX + 1).collect() if len(keys) == 1 else None

        def key_hit(stored: DataFrame) -> DataFrame:
            if few is not None and len(few) <= KEY_LIST_MAX:
                # a short key list goes into the Parquet scan as IN (row groups
                # whose min/max or dictionary exclude every key are skipped)
                vals = [r[0] for r in few if r[0] is not None]
                cond = F.col(keys[0]).isin(vals)
                if len(vals) < len(few):
                    cond = cond | F.col(keys[0]).isNull()
                return stored.where(cond)
            cond = [stored[k].eqNullSafe(bkeys[f"_k_{k}"]) for k in keys]
            return stored.join(maybe_broadcast(bkeys, MERGE_BROADCAST_ROWS), cond, "left_semi")
        touched |= _dirs_where(spark, kind, untouched, key_hit)
        untouched = [p for p in current.paths if p not in touched]
    srcs = None
    if replaced_sources is not None:
        srcs = maybe_broadcast(replaced_sources.select("source_file").distinct(), MERGE_BROADCAST_ROWS)
        if untouched:
            touched |= _dirs_where(spark, kind, untouched,
                                   lambda stored: stored.join(srcs, "source_file", "left_semi"))
            untouched = [p for p in current.paths if p not in touched]
    existing = store.read_dirs(spark, sorted(touched), kind)
    if srcs is not None:
        existing = existing.join(srcs, "source_file", "left_anti")
    merged = upsert(existing, staged, keys)
    new_dirs = store.write_table(merged, out, kind, codec)
    return untouched + new_dirs


def _counted(spark: SparkSession, staged: dict[str, DataFrame], path: str) -> DataFrame:
    """Rows per file of the tables just written (one column of them is read), written:
    one row per file."""
    frames = [df.groupBy(F.lit(kind).alias("data_type"), "source_file").agg(F.count(F.lit(1)).alias("records"))
              for kind, df in staged.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    out.write.mode("errorifexists").parquet(path)
    return spark.read.schema(out.schema).parquet(escape_glob(path))


def _manifest_rows(inv: DataFrame, counts: DataFrame, run_id: str, at: dt.datetime) -> DataFrame:
    """Manifest rows of the files of ``inv`` that were there to be read.  A file
    without rows is looked at once more: gone between its header and the scan, it
    must not pass for loaded."""
    keys = ["data_type", "source_file"]
    none = inv.join(counts, keys, "left_anti").select("data_type", "path")
    gone = set() if none.isEmpty() else vanished(file_headers(none))
    rows = inv.join(counts, keys, "left").select(
        "data_type", "path", "length", "modified", F.coalesce("records", F.lit(0)).cast("long").alias("records"),
        F.lit(run_id).alias("run_id"), F.lit(at.replace(tzinfo=None)).cast("timestamp").alias("committed_at"))
    return rows.where(~F.col("path").isin(sorted(gone))) if gone else rows


@contextmanager
def _utc(spark: SparkSession):
    """Months and parsed times of a load are in UTC, whatever the session's zone."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def load_files(spark: SparkSession, inv_all: DataFrame, target: str, mode: str,
               kinds: Sequence[str], layout: str, compression: str = "snappy",
               now: dt.datetime | None = None, run_id: str | None = None,
               replace_by_source: bool = False, strict: bool = False) -> LoadResult:
    """Load the files listed in ``inv_all`` (an inventory frame) into
    ``target`` with ``mode`` full / incremental / append.

    Jobs: one to pick the files (incremental / append), one to read their
    header lines, one clean-and-write per table (plus the merge write for an
    incremental upsert), one for the manifest counts and one commit for all
    tables together."""
    codec = store.check_codec(compression)
    now = now or dt.datetime.now(dt.timezone.utc)
    size = inv_all.where(F.col("data_type").isin(list(kinds))).agg(F.sum("length")).first()[0] or 0
    with _utc(spark), sized(spark, size // ROW_BYTES):
        return _load_files(spark, inv_all, target, mode, kinds, layout, codec, now, run_id or store.new_run_id(now),
                           replace_by_source, strict)


def _load_files(spark: SparkSession, inv_all: DataFrame, target: str, mode: str, kinds: Sequence[str], layout: str,
                codec: str, now: dt.datetime, run_id: str, replace_by_source: bool, strict: bool) -> LoadResult:
    result = LoadResult(run_id, mode)
    with _step("versions"):
        versions = store.latest_versions(spark, target)
        newest = max((v.committed_at for v in versions.values()), default=None)
        # newer than the last load, whatever the clocks say
        at = now if newest is None else max(now, (newest + dt.timedelta(microseconds=1)).replace(tzinfo=now.tzinfo))
        store.drop_unlisted(spark, target, versions, KINDS)
    inv_all = inv_all.where(F.col("data_type").isin(list(kinds)))
    if mode in ("incremental", "append") and versions:
        manifest = store.committed_manifest(spark, target)
        pick = changed_files if mode == "incremental" else new_files
        inv_all = pick(inv_all, manifest)
    inv_all = inv_all.select(*INVENTORY.fieldNames())
    with _step("list files"):
        rows = inv_all.collect()                  # the files of this batch (metadata)
    with _step("headers"):
        headers = file_headers(spark.createDataFrame(rows, INVENTORY), len(rows)) if rows else {}
        bad = rejected(headers)
        if bad and strict:
            path, reason = next(iter(bad.items()))
            raise UnreadableHeader(f"{path}: {reason}")
        out_of = vanished(headers) | set(bad)
        headers = without(headers, out_of)
        failed = [(r["data_type"], r["path"], r["length"], r["modified"], bad[r["path"]]) for r in rows if r["path"] in bad]
        rows = [r for r in rows if r["path"] not in out_of]
    if failed:
        for _, path, _, _, reason in failed:
            log.warning("rejected %s: %s", path, reason)
        store.write_rejects(spark, target, spark.createDataFrame(failed, "data_type string, path string, length long, modified timestamp, reason string"), run_id)
    result.rejected = len(failed)
    batch_inv = spark.createDataFrame(rows, INVENTORY)
    per_kind = {k: sum(1 for r in rows if r["data_type"] == k) for k in kinds}
    etl_ts = F.lit(now.replace(tzinfo=None)).cast("timestamp")
    committed: dict[str, tuple[list[str], int]] = {}
    written: dict[str, DataFrame] = {}
    for kind in kinds:
        current = versions.get(kind)
        if per_kind[kind] == 0:
            result.tables[kind] = {"files": 0, "version": current.run_id if current else None}
            continue
        inv = batch_inv.where(F.col("data_type") == kind)
        bronze = read_bronze(spark, inv, kind, layout, headers=headers)
        batch = CLEANERS[kind](bronze, etl_ts=etl_ts)
        out = store.data_path(target, kind, run_id)
        if mode == "incremental" and current is not None:
            stage = f"{target.rstrip('/')}/_staging/{run_id}/{kind}"
            with _step(f"{kind}: clean + stage"):
                batch.write.mode("errorifexists").option("compression", codec).parquet(stage)
            staged = spark.read.schema(SILVER[kind]).parquet(escape_glob(stage))
            with _step(f"{kind}: upsert"):
                paths = upsert_partitions(spark, current, staged, kind, out, codec,
                                          replaced_sources=inv if replace_by_source else None)
        else:
            with _step(f"{kind}: clean + write"):
                new_dirs = store.write_table(batch, out, kind, codec)
            staged = store.read_dirs(spark, new_dirs, kind)
            paths = ([*current.paths, *new_dirs] if (mode == "append" and current is not None)
                     else new_dirs)
        written[kind] = staged
        committed[kind] = (paths, per_kind[kind])
        result.tables[kind] = {"files": per_kind[kind], "version": run_id, "paths": paths}
    if committed:
        with _step("manifest"):
            counts = _counted(spark, written, f"{target.rstrip('/')}/_staging/{run_id}/_records")
            m = _manifest_rows(batch_inv.where(F.col("data_type").isin(list(committed))), counts, run_id, at)
            store.write_manifest(spark, target, m, run_id, list(committed) if mode == "full" else [])
        with _step("commit"):
            store.commit(spark, target, run_id, mode, committed, at)
        store.delete(spark, f"{target.rstrip('/')}/_staging/{run_id}")
    return result


def _load(spark: SparkSession, source: str, target: str, mode: str, kinds: Sequence[str],
          layout: str, compression: str, now: dt.datetime | None,
          replace_by_source: bool = False, strict: bool = False) -> LoadResult:
    store.check_codec(compression)
    inv_all = file_inventory(spark, source, kinds, layout)
    return load_files(spark, inv_all, target, mode, kinds, layout, compression, now,
                      replace_by_source=replace_by_source, strict=strict)


def full_load(spark: SparkSession, source: str, target: str, kinds: Sequence[str] = ("bills", "readings"),
              layout: str = "tree", compression: str = "snappy", now: dt.datetime | None = None,
              strict: bool = False) -> LoadResult:
    return _load(spark, source, target, "full", kinds, layout, compression, now, strict=strict)


def incremental_load(spark: SparkSession, source: str, target: str,
                     kinds: Sequence[str] = ("bills", "readings"), layout: str = "tree",
                     compression: str = "snappy", now: dt.datetime | None = None,
                     replace_by_source: bool = False, strict: bool = False) -> LoadResult:
    """Upsert new and changed files.  ``replace_by_source=True`` also drops
    stored rows of a changed file that its new content no longer has."""
    return _load(spark, source, target, "incremental", kinds, layout, compression, now,
                 replace_by_source, strict)


def append_load(spark: SparkSession, source: str, target: str,
                kinds: Sequence[str] = ("bills", "readings"), layout: str = "tree",
                compression: str = "snappy", now: dt.datetime | None = None, strict: bool = False) -> LoadResult:
    return _load(spark, source, target, "append", kinds, layout, compression, now, strict=strict)
