"""Sharding by sampled splitters (DataFrame functions only).

Records are ordered by a hash of their text, so that equal texts stand side by
side.  Size-weighted key samples give quantile boundaries; records are
range-partitioned between them; a range that still holds too many bytes (a large
group of equal texts) is subdivided.  Large groups of equal texts that fit into a
shard are given one each; the exact bytes of the units then place all other groups on
the line of the remaining bytes, which is cut where the shards are full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meterlake.llm.common import fresh, materialise, search, text_of, uniform

# Ranges: at least so many, and so many rows in each on average, but no more boundaries
# than a plan can hold.
LEAST_RANGES, RANGE_ROWS, MOST_RANGES = 512, 2_000_000, 16_384
SAMPLES_PER_RANGE = 32
# A range or group with more bytes than this times the mean of a range is subdivided.
OVERFULL = 1.5


def _digest(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = text_of(text_column)
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_column)) + 1, F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("key"))


def splitters(records: DataFrame, ranges: int, samples: int) -> list[int]:
    """At most ``ranges - 1`` boundaries: quantiles of about ``samples`` keys
    drawn with a chance in proportion to a record's size (the sample is bounded
    and alone reaches the driver; a large record counts as many draws)."""
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if not total or ranges < 2:
        return []
    # draws of a record: its expected number, rounded up or down by a hash
    expected = F.col("size") * F.lit(samples / total)
    draws = F.floor(expected + uniform(F.lit("sample"), F.col("doc_id"), F.col("key"), F.col("size"))).cast("int")
    sample = (records.select("key", draws.alias("draws")).filter("draws > 0")
              .groupBy("key").agg(F.sum("draws").alias("draws")).orderBy("key").collect())
    step = sum(r["draws"] for r in sample) / ranges
    bounds, seen = [], 0
    for r in sample:
        seen += r["draws"]
        if step and len(bounds) < ranges - 1 and seen >= step * (len(bounds) + 1):
            bounds.append(r["key"] + 1)  # the key's group stays whole below the boundary
            while len(bounds) < ranges - 1 and seen >= step * (len(bounds) + 1):
                bounds.append(r["key"] + 1)
    return sorted({b for b in bounds if b < 1 << 63})


def whole_groups(groups: list[tuple[int, int]], total: int, n_shards: int) -> tuple[dict[int, int], list[int]]:
    """The shard of each large group (key, bytes) that fits whole, and the bytes that
    the shards hold then: largest first, each into the emptiest shard if it has room."""
    room, held, places = total / n_shards, [0] * n_shards, {}
    for key, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        s = min(range(n_shards), key=lambda k: (held[k], k))
        if held[s] + size <= room:
            places[key] = s
            held[s] += size
    return places, held


def shard(docs: DataFrame, n_shards: int = 8, id_column: str = "doc_id", text_column: str = "text",
          ranges: int | None = None, samples_per_range: int = SAMPLES_PER_RANGE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row, under the law of equal
    bytes: shard sizes differ by about one unit, a unit being at most 1.5 times
    the bytes of a range.  ``slot`` counts 0, 1, 2, ... within a shard.

    size: UTF-8 bytes of the text (null: none) plus 1.  Rows with equal texts
    share a shard; only a group for which no shard has room (it alone has more bytes
    than a shard, or other such groups fill them) is spread by id.  Repeated rows are
    placed one by one; null ids sort first.  Other columns are ignored; an empty table
    gives an empty result.  ``ranges`` grows with the rows unless it is given.
    """
    spark = docs.sparkSession
    records = materialise(_digest(docs, id_column, text_column), "shard-records")
    total, n_rows = records.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = ranges or min(MOST_RANGES, max(LEAST_RANGES, n_rows // RANGE_ROWS))
    target = max(total, 1) / max(ranges, n_shards)
    bounds = splitters(records, ranges, ranges * samples_per_range)
    ranged = materialise(records.withColumn("range", search(F.col("key"), bounds)), "shard-ranges")
    # at most `ranges` rows
    plan = ranged.groupBy("range").agg(F.sum("size").alias("bytes")).select(
        F.col("range").alias("r"),
        F.when(F.col("bytes") > OVERFULL * target, F.ceil(F.col("bytes") / target)).otherwise(1).cast("int").alias("pieces"))
    # keys that alone are overfull: at most as many as there are ranges, since their bytes add up to no more than all
    groups = [(r["key"], r["bytes"]) for r in ranged.groupBy("key").agg(F.sum("size").alias("bytes"))
              .filter(F.col("bytes") > OVERFULL * target).collect()]
    places, held = whole_groups(groups, total, n_shards)
    hot = spark.createDataFrame([(k, places.get(k)) for k, _ in groups], "hot_key long, own_shard int")
    # where the shards are full, on the line of what has no shard yet
    cuts = [int(total * (s + 1) / n_shards) - sum(held[:s + 1]) for s in range(n_shards - 1)]
    # a piece of a range: by key, but by id for a large group, which no task takes whole
    spread = F.when(F.col("hot_key").isNull(), F.xxhash64(F.lit("piece"), F.col("key"))).otherwise(
        F.xxhash64(F.lit("piece"), F.col("doc_id"), F.col("size")))
    piece = F.when(F.col("pieces") == 1, F.lit(0)).otherwise(F.pmod(spread, F.col("pieces"))).cast("int")
    units = materialise(
        ranged.join(F.broadcast(plan), F.col("range") == F.col("r"))
        .join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left").withColumn("piece", piece)
        .select("doc_id", "size", "text_crc32", "key", "range", "piece", "own_shard",
                F.when(F.col("own_shard").isNull(), F.col("size")).otherwise(F.lit(0).cast("long")).alias("open_size")), "shard-units")
    # at most `ranges` + 2/3 `ranges` + 1 units: one row each
    before = W.orderBy("range", "piece").rowsBetween(W.unboundedPreceding, -1)
    starts = (units.groupBy("range", "piece").agg(F.sum("open_size").alias("bytes"))
              .select(F.col("range").alias("r"), F.col("piece").alias("p"),
                      F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")))
    unit = W.partitionBy("range", "piece")
    running = unit.orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = (units.join(F.broadcast(starts), (F.col("range") == F.col("r")) & (F.col("piece") == F.col("p")))
              .withColumn("_before", F.coalesce(F.sum("open_size").over(running), F.lit(0)))
              # where the record's group of equal texts begins in this unit
              .withColumn("_group", F.min("_before").over(W.partitionBy("range", "piece", "key")))
              .withColumn("shard", F.coalesce("own_shard", search(F.col("start") + F.col("_group"), cuts)).cast("int"))
              .select("doc_id", "size", "text_crc32", "key", "range", "piece", "shard"))
    return _slots(materialise(placed, "shard-placed"))


def _slots(placed: DataFrame) -> DataFrame:
    """Number the rows of a shard: within the unit, after the rows of earlier units."""
    counts = placed.groupBy("shard", "range", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("range", "piece").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select(F.col("shard").alias("s"), F.col("range").alias("r"), F.col("piece").alias("p"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    row = F.row_number().over(W.partitionBy("shard", "range", "piece").orderBy("key", "doc_id", "size"))
    on = (F.col("shard") == F.col("s")) & (F.col("range") == F.col("r")) & (F.col("piece") == F.col("p"))
    return (placed.withColumn("row", row).join(F.broadcast(shift), on)
            .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("row") - 1).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the rows of ``docs`` as one folder ``shard=k`` for each shard, in many files
    where a shard is large.  Every row is written once: rows that agree in id and text
    take the least of their places, so repeated rows stay together."""
    plain = docs.drop("shard", "slot")
    own, size, crc, key = fresh(plain, "shard_id", "shard_size", "shard_crc", "shard_key")
    placed = shard(plain, n_shards, id_column, text_column).groupBy("doc_id", "size", "text_crc32").agg(F.min("shard").alias("shard"))
    placed = placed.toDF(own, size, crc, "shard")
    text = text_of(text_column)
    rows = plain.withColumns({key: F.coalesce(F.octet_length(F.col(text_column)) + 1, F.lit(1)).cast("long")})
    same = (F.col(id_column).eqNullSafe(F.col(own)) & (F.col(key) == F.col(size)) & (F.crc32(F.encode(text, "UTF-8")).cast("long") == F.col(crc)))
    (rows.join(placed, same).drop(own, size, crc, key)
     .hint("rebalance", "shard").write.partitionBy("shard").parquet(path))
