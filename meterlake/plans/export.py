"""Write bronze rows back out as a text tree (per division / subdivision).

Rows are range-partitioned on (division, subdivision, original order), so a
subdivision that holds a third of all rows is split over many tasks and
files; part files are named in task order, so reading a subdivision's files
in name order returns the rows in their original order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from meterlake.schemas import KINDS
from meterlake.session import partitions_for

# Lines of a log that one task writes.
ROWS_PER_TASK = 2_000_000


def export_tree(df: DataFrame, root: str, kind: str, partitions: int | None = None,
                mode: str = "errorifexists", max_records_per_file: int | None = None,
                columns: list[str] | None = None,
                render: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write ``df`` (bronze text columns + division, subdivision, ``_ord``)
    as ``<root>/<kind>/division=<d>/subdivision=<s>/part-*.csv`` with a
    header line, columns in ``columns`` order (default: the canonical
    order).  ``df`` may hold other, narrower columns beside division, subdivision
    and ``_ord``: ``render`` then makes the text of rows already in place, row by
    row.  Returns the folder written."""
    spec = KINDS[kind]
    spark = df.sparkSession
    if partitions is None:
        # size the range partitions from the data (one counting pass) so that a
        # task sorts its rows in memory whatever the input size
        partitions = partitions_for(spark, df.count())
    n = partitions
    order = ["division", "subdivision", "_ord"]
    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    if render:
        ordered = render(ordered)
    out = f"{root.rstrip('/')}/{spec['folder']}"
    cols = columns or spec["columns"]
    if sorted(cols) != sorted(spec["columns"]):
        raise ValueError(f"columns must be a permutation of {spec['columns']}")
    w = (ordered.select(*cols, "division", "subdivision").write.mode(mode).partitionBy("division", "subdivision")
         .option("header", "true").option("sep", spec["sep"])
         .option("quote", '"').option("escape", '"'))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.csv(out)
    return out
