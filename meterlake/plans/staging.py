"""Bronze trees and loaded targets staged from the test tables.

The file-based operators (scans, inventory, loads, manifest, coverage) need
files.  These helpers export the stand-in bronze rows of the test tables as a
text tree in the cluster's shared folder and run the loads on it, once per
(Spark application, table folder).

Two arrival batches cover *all* rows: bills shipped before 1998 arrive first,
the rest later; readings flagged OK arrive first, ISSUE rows later.  Keys
straddle the two batches, so the upsert really has to choose.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.plans import export, load, standins, store
from meterlake.schemas import KINDS
from meterlake.sources.inventory import INVENTORY
from meterlake.sources.silver import scan_silver
from meterlake.session import partitions_for, scratch_path, sized

BILL_CUT = "1998-01-01"
CANONICAL_ORDER_DIVISIONS = ("AFRICA", "AMERICA")


def first_batch(kind: str) -> Column:
    if kind == "bills":
        return F.col("_ord.l_shipdate") < F.lit(BILL_CUT).cast("timestamp_ntz")
    return F.col("quality_flag") == "OK"


def bronze(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return (standins.bills_bronze if kind == "bills" else standins.readings_bronze)(spark, sf_dir)


@dataclass
class Staged:
    tree: str            # full tree (two header layouts for bills)
    silver: str          # full load of `tree`


@dataclass
class Arrivals:
    tree: str            # tree written as batch 1, then batch 2 appended
    first: list          # inventory rows of batch 1


BOTH = ("bills", "readings")
# Keyed by session and tables: the folders; the kinds that are there already.
_TREES: dict[tuple[str, str], tuple[str, set[str]]] = {}
_SILVER: dict[tuple[str, str], tuple[str, set[str]]] = {}
_ARRIVALS: dict[tuple, Arrivals] = {}
_LOADED: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, sf_dir)


def _rows(spark: SparkSession, sf_dir: str, kind: str) -> int:
    """Rows of the table that the kind has a row for each of (from Parquet footers)."""
    return standins.table(spark, sf_dir, "lineitem" if kind == "bills" else "events").count()


def _exported(spark: SparkSession, sf_dir: str, kind: str, root: str, where: Column | None = None,
              mode: str = "errorifexists", columns: list[str] | None = None) -> None:
    """Export the kind's rows (those of ``where``).  Bills are shuffled as numbers; their
    text is made of rows that are in place."""
    rows = _rows(spark, sf_dir, kind)
    with sized(spark, rows):
        df = standins.bills_rows(spark, sf_dir) if kind == "bills" else standins.readings_bronze(spark, sf_dir)
        export.export_tree(df if where is None else df.where(where), root, kind, partitions_for(spark, rows), mode,
                           columns=columns, render=standins.bills_text if kind == "bills" else None)


def staged_tree(spark: SparkSession, sf_dir: str, kinds: Sequence[str] = BOTH) -> str:
    """The bronze tree of all rows of ``kinds``.  Bills of two regions are written in the
    canonical column order, all other bills with the columns reversed: the
    tree holds two header layouts and scans must bind columns by name."""
    tree, there = _TREES.setdefault(_key(spark, sf_dir), (scratch_path(spark, "tree"), set()))
    for kind in [k for k in kinds if k not in there]:
        if kind == "bills":
            canonical = F.col("division").isin(*CANONICAL_ORDER_DIVISIONS)
            _exported(spark, sf_dir, kind, tree, canonical)
            _exported(spark, sf_dir, kind, tree, ~canonical, "append", list(reversed(KINDS["bills"]["columns"])))
        else:
            _exported(spark, sf_dir, kind, tree)
        there.add(kind)
    return tree


def staged(spark: SparkSession, sf_dir: str, kinds: Sequence[str] = BOTH) -> Staged:
    """The tree and its full load, of ``kinds``."""
    tree = staged_tree(spark, sf_dir, kinds)
    silver, there = _SILVER.setdefault(_key(spark, sf_dir), (scratch_path(spark, "silver"), set()))
    missing = [k for k in kinds if k not in there]
    if missing:
        load.full_load(spark, tree, silver, missing, layout="hive")
        there.update(missing)
    return Staged(tree=tree, silver=silver)


def arrivals(spark: SparkSession, sf_dir: str, kind: str) -> Arrivals:
    """The two arrival batches of a kind in one tree."""
    key = (*_key(spark, sf_dir), kind)
    if key not in _ARRIVALS:
        tree = scratch_path(spark, f"batches-{kind}")
        _exported(spark, sf_dir, kind, tree, first_batch(kind))
        first = load.frozen_inventory(spark, tree, [kind], "hive").collect()
        _exported(spark, sf_dir, kind, tree, ~first_batch(kind), "append")
        _ARRIVALS[key] = Arrivals(tree, first)
    return _ARRIVALS[key]


def _first_load(spark: SparkSession, sf_dir: str, kind: str, label: str) -> str:
    """A target with the full load of batch 1, and beside it its manifest of then; made once."""
    key = (*_key(spark, sf_dir), kind, label)
    if key not in _LOADED:
        target = scratch_path(spark, f"{label}-{kind}")
        inventory = spark.createDataFrame(arrivals(spark, sf_dir, kind).first, INVENTORY)
        load.load_files(spark, inventory, target, "full", [kind], "hive")
        store.committed_manifest(spark, target).write.parquet(f"{target}-known")
        _LOADED[key] = target
    return _LOADED[key]


def first_manifest(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """The manifest of the kind's full load of batch 1."""
    return f"{_first_load(spark, sf_dir, kind, 'merged')}-known"


def _second_load(spark: SparkSession, sf_dir: str, kind: str, label: str, then: Callable) -> str:
    target, key = _first_load(spark, sf_dir, kind, label), (*_key(spark, sf_dir), kind, label, "batch 2")
    if key not in _LOADED:
        then(spark, arrivals(spark, sf_dir, kind).tree, target, [kind], layout="hive")
        _LOADED[key] = target
    return target


def merged(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Target of a full load of batch 1, then an incremental one."""
    return _second_load(spark, sf_dir, kind, "merged", load.incremental_load)


def appended(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Target of a full load of batch 1, then an append load."""
    return _second_load(spark, sf_dir, kind, "appended", load.append_load)


# Log level per event type of the stand-in run log.
EVENT_LEVEL = {"error": "ERROR", "signup": "WARNING", "click": "DEBUG"}


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event, in (ts, event_id) order."""
    ev = standins.table(spark, sf_dir, "events")
    level = F.lit("INFO")
    for et, lv in EVENT_LEVEL.items():
        level = F.when(F.col("event_type") == et, lv).otherwise(level)
    line = F.concat_ws(" - ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), level,
                       F.format_string("event %d %s user=%d", "event_id", "event_type", "user_id"))
    return ev.select("ts", "event_id", line.alias("value"))


_LOGS: dict[tuple[str, str], str] = {}


def staged_log(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> str:
    """The run log written as text files whose name order is line order."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOGS:
        path = scratch_path(spark, "runlog")
        lines = log_lines(spark, sf_dir)
        if partitions is None:
            floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
            partitions = max(floor, -(-lines.count() // export.ROWS_PER_TASK))
        (lines.repartitionByRange(partitions, "ts", "event_id")
         .sortWithinPartitions("ts", "event_id").select("value").write.text(path))
        _LOGS[key] = path
    return _LOGS[key]


_CORRUPT: dict[tuple[str, str], str] = {}


def with_corrupt_part(spark: SparkSession, sf_dir: str) -> str:
    """The staged silver bills as one Parquet folder per division, and beside them junk
    that is no Parquet file, a valid part without rows, and two whole divisions
    (``DAMAGED``) whose every part is damaged in the middle."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CORRUPT:
        path = scratch_path(spark, "corrupt")
        bills = scan_silver(spark, staged(spark, sf_dir, ["bills"]).silver, "bills")
        for division in sorted(r[0] for r in bills.select("division").distinct().collect()):    # a handful
            out = f"{path}/{division.lower().replace(' ', '-')}"
            bills.where(F.col("division") == division).write.parquet(out)
            if division in DAMAGED:
                _damage(spark, out)
        bills.where("false").coalesce(1).write.parquet(f"{path}/none")
        spark.createDataFrame([("this is not a parquet file",)], "value string") \
            .coalesce(1).write.text(f"{path}/junk")
        _CORRUPT[key] = path
    return _CORRUPT[key]


DAMAGED = ("ASIA", "EUROPE")


def _damage(spark: SparkSession, folder: str) -> None:
    """Overwrite bytes in the middle of every part below ``folder``, through the same
    file system that Spark writes with."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.setVerifyChecksum(False)
    for status in fs.listStatus(root):
        if not status.getPath().getName().startswith("part-"):
            continue
        size = status.getLen()
        read = fs.open(status.getPath())
        content = bytearray(jvm.org.apache.commons.io.IOUtils.toByteArray(read))
        read.close()
        content[size // 2:size // 2 + 64] = bytes(64)
        written = fs.create(status.getPath(), True)
        written.write(content)
        written.close()


_REJECTS: dict[tuple[str, str], tuple[str, str]] = {}
BROKEN_DIVISION = "DIV03"


def staged_rejects(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A tree of all readings in which every file of one division lacks its voltage
    column, and the target of its load."""
    key = _key(spark, sf_dir)
    if key not in _REJECTS:
        tree, target = scratch_path(spark, "partly"), scratch_path(spark, "partly-silver")
        rows = bronze(spark, sf_dir, "readings")
        broken = F.col("division") == BROKEN_DIVISION
        export.export_tree(rows.where(~broken), tree, "readings")
        (rows.where(broken).drop("_ord", "voltage").write.mode("append").partitionBy("division", "subdivision")
         .option("header", "true").csv(f"{tree}/{KINDS['readings']['folder']}"))
        load.full_load(spark, tree, target, ["readings"], layout="hive")
        _REJECTS[key] = (tree, target)
    return _REJECTS[key]
