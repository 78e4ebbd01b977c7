"""Session helpers.

Library code never creates its own session; it receives one.  ``build_session``
is only a convenience for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _driver_memory() -> str:
    """60 % of physical memory, at most 8 GB (local mode: the driver is the
    whole cluster)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        gb = max(1, min(8, int(total * 0.6 / 2 ** 30)))
    except (ValueError, OSError, AttributeError):
        gb = 4
    return f"{gb}g"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "meterlake") -> SparkSession:
    master = master or os.environ.get("METERLAKE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("METERLAKE_DRIVER_MEMORY", _driver_memory()))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Every report is expressed in UTC; pin it even on a shared session.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


# Rows of a shuffle partition: some 300 bytes each in memory, sorted without spilling.
ROWS_PER_PARTITION = 250_000
# Bytes of a task, whatever the size of the tables: what AQE makes of small shuffle
# partitions and rebalanced months, and how files are cut.  In memory a sort holds some
# seven times as much of shuffled rows, nine of text.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20, "spark.sql.files.maxPartitionBytes": 16 << 20}


# Shuffle files go with the query that made them.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for so many rows, the session's number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PARTITION))


@contextmanager
def configured(spark: SparkSession, confs: dict[str, object]) -> Iterator[None]:
    """What is run inside has these settings; before's are put back after it."""
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside shuffles into partitions that don't grow with the rows (AQE
    joins those that turn out small), and sorts them in tasks of bounded size.  What a query
    shuffles there is deleted as soon as it has ended."""
    with configured(spark, {"spark.sql.shuffle.partitions": partitions_for(spark, rows), **CLEANED,
                            **{k: min(n, bytes_of(spark, k)) for k, n in TASK_BYTES.items()}}):
        yield


def bytes_of(spark: SparkSession, conf: str) -> int:
    """A setting as a number of bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(conf))


def shared_dir(spark: SparkSession) -> str:
    """Folder on the cluster's shared storage for staged tables.

    Uses ``spark.checkpoint.dir`` (or an already-set checkpoint dir).  Only
    when nothing is configured *and* the master is local (tests) do we set a
    local one; on a cluster an unset value is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master == "local" or sc.master.startswith("local["):   # one process; not local-cluster
        local = tempfile.mkdtemp(prefix="meterlake-ckpt-")
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir() or local
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at shared storage "
        "(HDFS / object store) before running staged jobs")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder name under the shared dir (not created)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/meterlake/{label}-{uuid.uuid4().hex[:12]}"
