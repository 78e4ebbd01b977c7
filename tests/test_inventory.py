from pyspark.sql import functions as F

from meterlake.operators import inventory as inv_ops
from meterlake.plans import load, store
from meterlake.sources.inventory import INVENTORY, file_inventory
from meterlake.sources.silver import scan_silver
from tests.conftest import BILL_HEADER, READING_HEADER, bill, reading, write_file


def _tree(tmp_path):
    root = tmp_path / "bronze"
    write_file(root, "D1", "S1", "bills", BILL_HEADER, [bill("B1"), bill("B2")])
    write_file(root, "D1", "S2", "bills", BILL_HEADER, [bill("B3", amount="-1")])   # no valid row
    write_file(root, "D2", "S1", "readings", READING_HEADER, [reading("2024-01-01 00:00:00")])
    return root


def test_coverage_and_zero_guard(spark, tmp_path):
    root = _tree(tmp_path)
    target = str(tmp_path / "silver")
    load.full_load(spark, str(root), target)
    inv = file_inventory(spark, str(root))
    cov = inv_ops.source_coverage(inv, {k: scan_silver(spark, target, k) for k in ("bills", "readings")})
    got = {(r.subdivision, r.data_type): r.covered for r in cov.collect()}
    assert got == {("S1", "bills"): True, ("S2", "bills"): False, ("S1", "readings"): True}
    summ = {r.data_type: r for r in inv_ops.coverage_summary(cov).collect()}
    assert summ["bills"].n_files == 2 and summ["bills"].pct_covered == 50.0
    empty = spark.createDataFrame([], INVENTORY)
    none = inv_ops.coverage_summary(inv_ops.source_coverage(
        empty, {"bills": scan_silver(spark, target, "bills")})).collect()
    assert none == []                                   # no division by zero, no row


def test_compression_uses_per_type_bytes(spark, tmp_path):
    root = _tree(tmp_path)
    target = str(tmp_path / "silver")
    load.full_load(spark, str(root), target)
    inv = file_inventory(spark, str(root))
    src = {r.data_type: r.b for r in inv.groupBy("data_type").agg(F.sum("length").alias("b")).collect()}
    lay = {k: inv_ops.layout_report(spark, v.paths) for k, v in store.latest_versions(spark, str(target)).items()}
    out = {r.data_type: r for r in inv_ops.compression_ratio(inv, lay).collect()}
    assert out["bills"].source_bytes == src["bills"] and out["readings"].source_bytes == src["readings"]
    assert out["bills"].silver_bytes > 0
    roll = {r.division: r for r in inv_ops.inventory_rollup(inv).collect()}
    assert roll["D1"].n_files == 2 and roll["D1"].n_subdivisions == 2
