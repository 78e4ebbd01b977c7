"""Continuous ingestion: new bronze files -> cleaned -> upserted into silver.

The stream is a ``binaryFile`` source over the bronze tree with only file
metadata selected (no content is read by the stream itself); its checkpoint
remembers which files were seen.  Each micro-batch is a small inventory of
new files, handed to the same batch path as ``incremental_load`` (header
binding by name, cleaning, keyed upsert, manifest, commit).

Exactly-once: the run id of a micro-batch is derived from the query name and
batch id, and a batch whose commit row already exists is skipped, so a batch
replayed after a failure does not apply twice.

The file source does not see a *changed* file at an already-seen path.  For trees
whose files are rewritten in place there is ``ingest_changed``, which compares the
tree with the manifest (length and modification time), once, and ``watch_changes``,
a streaming query that does so in each micro-batch.  All three write to one target:
what one has loaded, the others find in the manifest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.plans import store
from meterlake.plans.load import LoadResult, incremental_load, load_files
from meterlake.schemas import KINDS
from meterlake.sources.inventory import INVENTORY, escape_glob, path_lineage

# Fixed schema of Spark's binaryFile source (required for streaming).
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def _file_stream(spark: SparkSession, root: str, kinds: Sequence[str], layout: str,
                 max_files_per_trigger: int | None) -> DataFrame:
    """One stream of new bronze files of all ``kinds`` (file metadata only)."""
    root = escape_glob(root.rstrip("/"))
    folders = ",".join(KINDS[k]["folder"] for k in kinds)
    if layout == "tree":
        glob = f"{root}/*/*/{{{folders}}}"
        name = "{" + ",".join(KINDS[k]["file"] for k in kinds) + "}"
    else:
        glob, name = f"{root}/{{{folders}}}/*/*", "*"
    r = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
         .option("pathGlobFilter", name))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = r.load(glob).select("path", "length", "modificationTime")
    lin = path_lineage(F.col("path"), layout)
    seg = F.split(lin["path"], "/")
    folder = F.element_at(seg, -2) if layout == "tree" else F.element_at(seg, -4)
    kind = None
    for k in kinds:
        cond = folder == KINDS[k]["folder"]
        kind = F.when(cond, k) if kind is None else kind.when(cond, k)
    return files.select(
        kind.alias("data_type"), lin["path"].alias("path"), lin["source_file"].alias("source_file"),
        lin["division"].alias("division"), lin["subdivision"].alias("subdivision"),
        F.col("length"), F.col("modificationTime").alias("modified"),
    ).where(F.col("data_type").isNotNull() & ~F.col("division").startswith("."))


def stream_ingest(spark: SparkSession, source: str, target: str, checkpoint: str,
                  kinds: Sequence[str] = ("bills", "readings"), layout: str = "tree",
                  available_now: bool = True, processing_time: str = "60 minutes",
                  max_files_per_trigger: int | None = None, compression: str = "snappy",
                  name: str = "meterlake_ingest") -> list[StreamingQuery]:
    """Start the ingestion query (one for all kinds, so a micro-batch commits
    every table it touches at once).  Returns ``[query]``; call
    ``awaitTermination`` / ``stop`` on it."""
    store.check_codec(compression)
    kinds = list(kinds)

    def apply(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{name}-{batch_id:012d}"
        done = store.commits(spark, target)
        if done is not None and not done.where(F.col("run_id") == run_id).isEmpty():
            return                          # replay of a committed micro-batch
        rows = batch.collect()              # new files of this trigger (metadata)
        if not rows:
            return
        inv = spark.createDataFrame(rows, INVENTORY)
        load_files(spark, inv, target, "incremental", kinds, layout, compression,
                   now=dt.datetime.now(dt.timezone.utc), run_id=run_id)

    w = (_file_stream(spark, source, kinds, layout, max_files_per_trigger).writeStream
         .queryName(name).option("checkpointLocation", checkpoint).foreachBatch(apply))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return [w.start()]


def ingest_changed(spark: SparkSession, source: str, target: str, kinds: Sequence[str] = ("bills", "readings"),
                   layout: str = "tree", compression: str = "snappy", replace_by_source: bool = False) -> LoadResult:
    """One poll: load the files that are new, or changed at a known path, and upsert
    their rows.  Nothing is written if there are none.  With ``replace_by_source``, rows
    that a changed file no longer has are dropped."""
    return incremental_load(spark, source, target, kinds, layout, compression, replace_by_source=replace_by_source)


def watch_changes(spark: SparkSession, source: str, target: str, checkpoint: str,
                  kinds: Sequence[str] = ("bills", "readings"), layout: str = "tree",
                  processing_time: str = "60 minutes", available_now: bool = False, compression: str = "snappy",
                  replace_by_source: bool = False, name: str = "meterlake_watch") -> StreamingQuery:
    """Poll the tree in every micro-batch of a streaming query, ``processing_time`` apart
    (``available_now``: once).  The stream carries ticks only; what a tick loads is told
    by the manifest, so a replayed one finds nothing left to do."""
    store.check_codec(compression)

    def poll(_: DataFrame, batch_id: int) -> None:
        ingest_changed(spark, source, target, list(kinds), layout, compression, replace_by_source)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").load()
    w = ticks.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(poll)
    return (w.trigger(once=True) if available_now else w.trigger(processingTime=processing_time)).start()
