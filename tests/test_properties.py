"""Algebraic properties of the loads and the cleaning plan."""

from pyspark.sql import functions as F

from meterlake.operators import clean
from meterlake.plans import load
from meterlake.sources.bronze import read_bronze
from meterlake.sources.inventory import file_inventory
from meterlake.sources.silver import scan_silver
from tests.conftest import BILL_HEADER, bill, write_file


def _rows(spark, target):
    df = scan_silver(spark, target, "bills").drop("etl_timestamp")
    return sorted(map(tuple, df.collect()), key=str)


def test_two_incrementals_equal_one_full_when_keys_disjoint(spark, tmp_path):
    a = [bill(f"A{i}", kwh=str(i + 1), month=f"2024-0{1 + i % 3}") for i in range(20)] + [bill("A1", kwh="9")]
    b = [bill(f"B{i}", kwh=str(i + 2), month=f"2024-0{1 + i % 4}") for i in range(15)]
    both = tmp_path / "both"
    write_file(both, "D1", "S1", "bills", BILL_HEADER, a)
    write_file(both, "D2", "S1", "bills", BILL_HEADER, b)
    load.full_load(spark, str(both), str(tmp_path / "full"), kinds=["bills"])

    inc = tmp_path / "inc"
    write_file(inc, "D1", "S1", "bills", BILL_HEADER, a)
    load.incremental_load(spark, str(inc), str(tmp_path / "t"), kinds=["bills"])
    write_file(inc, "D2", "S1", "bills", BILL_HEADER, b)
    load.incremental_load(spark, str(inc), str(tmp_path / "t"), kinds=["bills"])
    assert _rows(spark, str(tmp_path / "full")) == _rows(spark, str(tmp_path / "t"))


def test_upsert_idempotent(spark):
    schema = "k string, v long"
    existing = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], schema)
    batch = spark.createDataFrame([("b", 20), (None, 30), ("c", 40)], schema)
    once = load.upsert(existing, batch, ["k"])
    twice = load.upsert(once, batch, ["k"])
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)
    assert sorted(once.collect(), key=str) == sorted(
        [("a", 1), ("b", 20), (None, 30), ("c", 40)], key=str)


def test_clean_plan_has_one_key_exchange(spark, tmp_path):
    write_file(tmp_path, "D1", "S1", "bills", BILL_HEADER, [bill("X1"), bill("X2")])
    inv = file_inventory(spark, str(tmp_path), ["bills"])
    df = clean.clean_bills(read_bronze(spark, inv, "bills"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None


def test_sample_is_by_key_and_not_by_partition(spark):
    from meterlake.operators.setops import sample_rows

    df = spark.range(20_000).selectExpr("id % 9000 AS k", "id AS v", "case when id % 7 = 0 then null else cast(id AS string) end AS s")
    some = {tuple(r) for r in sample_rows(df, 0.1, ["k"]).collect()}
    assert some == {tuple(r) for r in sample_rows(df.repartition(13).orderBy("s"), 0.1, ["k"]).collect()}
    keys = {k for k, _, _ in some}
    assert {tuple(r) for r in df.collect() if r.k in keys} == some and 700 < len(keys) < 1100
    more = {tuple(r) for r in sample_rows(df, 0.3, ["k"]).collect()}
    assert some < more and some != {tuple(r) for r in sample_rows(df, 0.1, ["k"], seed=7).collect()}
    assert sample_rows(df, 0.0).count() == 0 and sample_rows(df, 1.0).count() == 20_000
