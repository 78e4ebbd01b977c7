"""Staged trees and targets: what is shuffled, how often, and that the rows stay the same."""

import datetime as dt
import time

from pyspark.sql import functions as F

from meterlake.operators.joins import split_join
from meterlake.plans import staging, standins
from meterlake.schemas import BILL_COLUMNS
from meterlake.session import TASK_BYTES, partitions_for, sized
from meterlake.sources.bronze import read_bronze
from meterlake.sources.inventory import file_inventory


def _tables(spark, d):
    t = dt.datetime(1998, 3, 1)
    rows = {
        "region": ([(0, "ASIA"), (1, "AFRICA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "CHINA", 0), (1, "KENYA", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, 0, 5.0), (2, 1, -3.0), (3, 1, 0.0)], "c_custkey long, c_nationkey int, c_acctbal double"),
        "orders": ([(k, k % 3 + 1) for k in range(70, 110)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(k, k % 5, 1, n, float(n), 10.5 * k, 0.1, 0.05, "NAR"[k % 3], "O", t - dt.timedelta(days=k * n))
                      for k in range(70, 110) for n in (1, 2, 2)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": ([(k, t + dt.timedelta(hours=k), k % 4, "error" if k % 3 else "click", float(k), '{"k": 30}') for k in range(40)],
                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{d}/{name}.parquet")
    return str(d)


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_of_loads_and_exports_go_when_they_are_written(spark, tmp_path):
    before = _shuffle_files(spark)
    with sized(spark, 10):
        rows = spark.range(3000).repartition(3).groupBy((F.col("id") % 700).alias("k")).count()
        rows.repartitionByRange(4, "k").write.parquet(str(tmp_path / "rows"))
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 700


def test_exported_bills_are_those_of_the_text_rows(spark, tmp_path):
    """Bills go through the shuffle as numbers; the files hold the same text, in order."""
    sf = _tables(spark, tmp_path)
    tree = staging.staged_tree(spark, sf, ["bills"])
    read = read_bronze(spark, file_inventory(spark, tree, ["bills"], "hive"), "bills", "hive")
    cols = [*BILL_COLUMNS, "division", "subdivision"]
    got = sorted(str(tuple(r)) for r in read.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols]).collect())
    text = standins.bills_bronze(spark, sf)
    want = sorted(str(tuple(r)) for r in text.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols]).collect())
    assert got == want and len(got) == 120
    assert not standins.bills_rows(spark, sf).schema["_ord"].dataType.names.count("source_file")


def test_a_kind_is_staged_without_the_other(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    target = staging.merged(spark, sf, "readings")
    key = staging._key(spark, sf)
    assert (*key, "bills") not in staging._ARRIVALS
    assert staging.merged(spark, sf, "readings") == target
    known = spark.read.parquet(staging.first_manifest(spark, sf, "readings"))
    assert {r.data_type for r in known.collect()} == {"readings"} and known.count() < file_inventory(
        spark, staging.arrivals(spark, sf, "readings").tree, ["readings"], "hive").count()


def test_partitions_grow_with_the_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert partitions_for(spark, 10) == int(before) and partitions_for(spark, 10_000_001) == 41
    with sized(spark, 10_000_001):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "41"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_split_join_makes_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(v):
        seen.add(1)
        return v
    many = spark.range(300).select(F.udf(mark, "long")(F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    few = spark.range(7).selectExpr("id AS k", "id AS w")
    assert split_join(many, few, "k", max_broadcast=2).count() == 300
    assert seen.value == 300


def test_tasks_stay_small_as_files_grow(spark, tmp_path):
    """A load cuts files, and joins shuffle partitions, to a size that a task sorts in
    memory; a smaller one of the session stays, and all are put back."""
    path = str(tmp_path / "text")
    spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("value")).write.text(path)
    names = {"spark.sql.files.openCostInBytes": str(64 << 20), **{k: str(256 << 20) for k in TASK_BYTES}}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        assert spark.read.text(path).rdd.getNumPartitions() == 1
        with sized(spark, 1):
            assert spark.read.text(path).rdd.getNumPartitions() >= 3
            assert {k: spark.conf.get(k) for k in TASK_BYTES} == {k: str(v) for k, v in TASK_BYTES.items()}
        assert {k: spark.conf.get(k) for k in names} == names
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        with sized(spark, 1):
            assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(1 << 20)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1m"
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
