"""File inventory of a bronze tree (path, division, subdivision, size, mtime).

Listing uses the ``binaryFile`` source with only metadata columns selected,
so no file content is read.  Two layouts are understood:

``tree``  ``<root>/<division>/<subdivision>/<kind>/<file>`` - the layout the
          meter data arrives in (one ``bills.tsv`` / ``readings.csv`` per
          subdivision).  Division folders starting with ``.`` are skipped.
``hive``  ``<root>/<kind>/division=<d>/subdivision=<s>/<part files>`` - what
          ``export_tree`` (a Spark partitioned write) produces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.schemas import KINDS

INVENTORY = T.StructType([
    T.StructField("data_type", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("division", T.StringType()),
    T.StructField("subdivision", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
])


_GLOB_CHARS = "\\*?[]{}"


def escape_glob(path: str) -> str:
    """A path the readers take literally (Hadoop treats ``*?[]{}\\`` as glob)."""
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in path)


def path_missing(e: AnalysisException) -> bool:
    """The error says that a path does not exist (and nothing else)."""
    return e.getCondition() == "PATH_NOT_FOUND"


def decode_uri(c: Column) -> Column:
    """File URIs percent-encode spaces etc. but leave ``+`` literal."""
    return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))


def path_lineage(uri: Column, layout: str) -> dict[str, Column]:
    """division / subdivision / source_file (path relative to the root)
    parsed from a file URI."""
    path = decode_uri(uri)
    segs = F.split(path, "/")
    rel = F.array_join(F.slice(segs, -4, 4), "/")
    if layout == "tree":
        div, sub = F.element_at(segs, -4), F.element_at(segs, -3)
    elif layout == "hive":
        # partition values are escaped once more by the writer
        div = decode_uri(F.regexp_replace(F.element_at(segs, -3), "^division=", ""))
        sub = decode_uri(F.regexp_replace(F.element_at(segs, -2), "^subdivision=", ""))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return {"path": path, "source_file": rel, "division": div, "subdivision": sub}


def _glob(root: str, kind: str, layout: str) -> str:
    spec = KINDS[kind]
    root = escape_glob(root.rstrip("/"))      # the root is literal, the pattern is not
    if layout == "tree":
        return f"{root}/*/*/{spec['folder']}/{spec['file']}"
    return f"{root}/{spec['folder']}/*/*/*"


def file_inventory(spark: SparkSession, root: str, kinds: Sequence[str] = ("bills", "readings"),
                   layout: str = "tree") -> DataFrame:
    """One row per bronze file: data_type, path (decoded, re-readable),
    source_file (relative), division, subdivision, length, modified.  One
    listing job for all kinds."""
    globs = [_glob(root, k, layout) for k in kinds]
    listed = None
    try:
        listed = spark.read.format("binaryFile").load(globs).select("path", "length", "modificationTime")
    except AnalysisException as e:
        if not path_missing(e):
            raise
        # some glob matches nothing: list the kinds one by one
        frames = []
        for g in globs:
            try:
                frames.append(spark.read.format("binaryFile").load(g)
                              .select("path", "length", "modificationTime"))
            except AnalysisException as missing:
                if not path_missing(missing):
                    raise
        for f in frames:
            listed = f if listed is None else listed.unionByName(f)
    if listed is None:
        return spark.createDataFrame([], INVENTORY)
    lin = path_lineage(F.col("path"), layout)
    folder = (F.element_at(F.split(lin["path"], "/"), -2) if layout == "tree"
              else F.element_at(F.split(lin["path"], "/"), -4))
    kind = None
    for k in kinds:
        cond = folder == KINDS[k]["folder"]
        kind = F.when(cond, k) if kind is None else kind.when(cond, k)
    out = listed.select(
        kind.alias("data_type"), lin["path"].alias("path"),
        lin["source_file"].alias("source_file"), lin["division"].alias("division"),
        lin["subdivision"].alias("subdivision"), F.col("length"),
        F.col("modificationTime").alias("modified"))
    # hidden division folders are not part of the tree
    return out.where(F.col("data_type").isNotNull() & ~F.col("division").startswith(".")) \
        .select(*INVENTORY.fieldNames())
