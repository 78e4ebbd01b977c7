"""Run-log scans: ``YYYY-MM-DD HH:MM:SS - LEVEL - message`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - ([A-Z]+) - (.*)$"


def scan_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of one log file or a folder of them, with ``_ord`` = (file,
    block start, row id): the order of lines, for first / last n."""
    raw = spark.read.text(path)
    return raw.select(
        F.col("value").alias("line"),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("_ord"))


def parse_log(lines: DataFrame) -> DataFrame:
    """Adds ts (timestamp), level and message; lines not in the format get
    NULL fields (and keep their text)."""
    ok = F.col("line").rlike(LOG_PATTERN)
    return lines.withColumns({
        "ts": F.when(ok, F.try_to_timestamp(F.regexp_extract("line", LOG_PATTERN, 1),
                                            F.lit("yyyy-MM-dd HH:mm:ss"))),
        "level": F.when(ok, F.regexp_extract("line", LOG_PATTERN, 2)),
        "message": F.when(ok, F.regexp_extract("line", LOG_PATTERN, 3)),
    })
