"""Bronze text scans that bind columns by header *name*, per file.

Spark's CSV reader binds an explicit schema by position, so a file whose
header lists the same columns in another order would be silently shifted.
Each file's first line is therefore read first (a tiny distributed read of a
few KB per file via ``mapInPandas``), files are grouped by header layout, and
each group is scanned once with ``header=true`` and a schema in that file
order.  The groups are unioned by name.  One pass over the data.

Every row carries ``_ord = (source_file, block start, row id)``: the order of
the row in its file, used by keep-first de-duplication.
"""

from __future__ import annotations

import csv
import io
import logging
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schemas import KINDS
from meterlake.sources.inventory import escape_glob, path_lineage

# The header reader runs on executors: ship this module's functions by value
# so executors need nothing installed beyond PySpark, pandas and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

log = logging.getLogger("meterlake.bronze")

def _local_path(uri: str) -> str | None:
    if uri.startswith("file:"):
        rest = uri[5:]
        while rest.startswith("//"):
            rest = rest[1:]
        return rest
    if "://" not in uri:
        return uri
    return None


# A first line longer than this is no header.
HEADER_BYTES = 1 << 20


def _first_line(uri: str, limit: int = HEADER_BYTES) -> bytes:
    local = _local_path(uri)
    if local is not None:
        with open(local, "rb") as fh:
            line = fh.readline(limit + 1)
        if len(line) > limit:
            raise ValueError(f"the first line has more than {limit} bytes")
        return line
    from pyarrow import fs as pafs  # remote stores (hdfs://, s3://, gs://)
    for hadoop_scheme in ("s3a://", "s3n://"):          # Hadoop's S3 schemes
        if uri.startswith(hadoop_scheme):
            uri = "s3://" + uri[len(hadoop_scheme):]
    filesystem, p = pafs.FileSystem.from_uri(uri)
    with filesystem.open_input_stream(p) as fh:
        buf = b""
        while b"\n" not in buf and len(buf) <= limit:
            chunk = fh.read(65536)
            if not chunk:
                break
            buf += chunk
        line = buf.split(b"\n", 1)[0]
        if len(line) > limit:
            raise ValueError(f"the first line has more than {limit} bytes")
        return line


def _headers(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in pdfs:
        heads = []
        for uri, sep in zip(pdf["path"], pdf["sep"]):
            try:
                line = _first_line(uri).decode("utf-8", errors="replace").lstrip("\ufeff").rstrip("\r\n")
            except FileNotFoundError:
                heads.append([VANISHED])        # since listing: not read, not recorded as read
                continue
            except Exception as e:  # noqa: BLE001 - reported by path on the driver
                heads.append([UNREADABLE, f"{type(e).__name__}: {e}"])
                continue
            heads.append(next(csv.reader(io.StringIO(line), delimiter=sep), []) if line else [])
        yield pd.DataFrame({"data_type": pdf["data_type"], "path": pdf["path"], "header": heads})


HeaderGroups = dict[tuple[str, tuple[str, ...]], list[str]]

# Markers in place of a header line: it could not be read (the file is rejected), or
# the file is gone (it is skipped, and read when it comes back).
UNREADABLE, VANISHED = "\x00unreadable", "\x00vanished"

# Columns without which no row of a file can be valid.
REQUIRED = {"bills": ["bill_id", "consumption_kwh", "total_amount"],
            "readings": ["timestamp", "meter_id", "reading", "consumption_kwh", "voltage"]}


class UnreadableHeader(RuntimeError):
    """The header line of a bronze file could not be read."""


def vanished(groups: HeaderGroups) -> set[str]:
    """Paths that were gone when their header was to be read."""
    return {p for (_, header), paths in groups.items() if header == (VANISHED,) for p in paths}


def rejected(groups: HeaderGroups) -> dict[str, str]:
    """Path -> reason of the files that cannot be loaded: the header line could not be
    read, or lacks a column that every valid row needs.  An empty file is no reject."""
    out = {}
    for (kind, header), paths in groups.items():
        if header[:1] == (UNREADABLE,):
            out.update(dict.fromkeys(paths, header[1]))
        elif header and header != (VANISHED,):
            missing = [c for c in REQUIRED[kind] if c not in header]
            if missing:
                out.update(dict.fromkeys(paths, f"missing columns: {', '.join(missing)}"))
    return out


def without(groups: HeaderGroups, gone: set[str]) -> HeaderGroups:
    """The groups without some paths."""
    left = {key: [p for p in paths if p not in gone] for key, paths in groups.items()}
    return {key: paths for key, paths in left.items() if paths}


FILES_PER_TASK = 200


def file_headers(files: DataFrame, n_files: int | None = None) -> HeaderGroups:
    """(data_type, header layout) -> paths, for every file of ``files`` (an
    inventory frame).  One small distributed job; one row per file comes back
    to the driver (file metadata, not data)."""
    sep = None
    for kind, spec in KINDS.items():
        cond = F.col("data_type") == kind
        sep = F.when(cond, spec["sep"]) if sep is None else sep.when(cond, spec["sep"])
    # ~FILES_PER_TASK first-line reads per task: on an object store each is
    # a round trip, so spread them over the cluster
    n = files.count() if n_files is None else n_files
    parts = max(1, -(-n // FILES_PER_TASK))
    heads = (files.select("data_type", "path", sep.alias("sep")).repartition(parts)
             .mapInPandas(_headers, "data_type string, path string, header array<string>"))
    groups: HeaderGroups = {}
    for r in heads.collect():
        header = tuple(r["header"] or ())
        groups.setdefault((r["data_type"], header), []).append(r["path"])
    return groups


def _unique(names: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen.get(n, 0)
        out.append(n if k == 0 else f"{n}__dup{k}")
        seen[n] = k + 1
    return out


def read_bronze(spark: SparkSession, files: DataFrame, kind: str, layout: str = "tree",
                ignore_missing: bool = True, headers: HeaderGroups | None = None) -> DataFrame:
    """Scan the bronze files listed in ``files`` (an inventory frame) for
    ``kind``.  Returns the canonical text columns, division, subdivision,
    source_file, ``_path`` and ``_ord``.  ``headers`` may carry the result
    of :func:`file_headers` for these files (saves one job)."""
    spec = KINDS[kind]
    columns = spec["columns"]
    if headers is None:
        headers = file_headers(files.where(F.col("data_type") == kind))
    parts = []
    for (dtype, header), paths in headers.items():
        if dtype != kind or not header or header == (VANISHED,):
            continue  # other kind, or nothing to read
        if header[:1] == (UNREADABLE,):
            # binding columns by position instead could shift them
            raise UnreadableHeader(f"{paths[0]}: {header[1]}")
        names = _unique(list(header))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = (spark.read.schema(schema)
               .option("header", "true").option("sep", spec["sep"])
               .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
               .option("ignoreMissingFiles", str(ignore_missing).lower())
               .csv([escape_glob(p) for p in paths]))
        lin = path_lineage(F.col("_metadata.file_path"), layout)
        parts.append(raw.select(
            *[(F.col(f"`{c}`") if c in names else F.lit(None).cast("string")).alias(c)
              for c in columns],
            lin["division"].alias("division"), lin["subdivision"].alias("subdivision"),
            lin["source_file"].alias("source_file"), lin["path"].alias("_path"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row")))
    if not parts:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in columns] + [
            T.StructField(c, T.StringType()) for c in ("division", "subdivision", "source_file", "_path")
        ] + [T.StructField("_block", T.LongType()), T.StructField("_row", T.LongType())])
        out = spark.createDataFrame([], empty)
    else:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
    return out.withColumn("_ord", F.struct("source_file", "_block", "_row")).drop("_block", "_row")
