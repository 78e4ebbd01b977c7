"""Benchmark: bronze text tree -> silver (full / incremental) -> reports.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line.  Every timed step is forced with a ``noop`` write
(whole plan executed, nothing collected) or is a load that writes Parquet.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from meterlake.operators import billing, quality, reports  # noqa: E402
from meterlake.plans import export, load, staging, standins  # noqa: E402
from meterlake.session import build_session, scratch_path  # noqa: E402
from meterlake.sources import dimensions as dims  # noqa: E402
from meterlake.sources.inventory import file_inventory  # noqa: E402
from meterlake.sources.silver import scan_silver  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          app_name="meterlake-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    base = scratch_path(spark, "bench")
    tree, silver, batches, merged = (f"{base}/tree", f"{base}/silver", f"{base}/batches", f"{base}/merged")

    def export_all():
        for kind in ("bills", "readings"):
            export.export_tree(staging.bronze(spark, sf_dir, kind), tree, kind)
    timed("export_bronze", export_all)
    src_bytes = file_inventory(spark, tree, layout="hive").agg(F.sum("length")).collect()[0][0] or 0

    # first load pays JVM / codegen / Python-worker warm-up; the repeat (a new
    # target, same files) shows the steady state.  Both are reported.
    timed("full_load", lambda: load.full_load(spark, tree, silver, layout="hive"))
    timed("full_load_repeat", lambda: load.full_load(spark, tree, f"{base}/silver2", layout="hive"))
    timed("incremental_noop", lambda: load.incremental_load(spark, tree, silver, layout="hive"))

    # two arrival batches covering all rows: load the first, merge the second
    for kind in ("bills", "readings"):
        b = staging.bronze(spark, sf_dir, kind)
        export.export_tree(b.where(staging.first_batch(kind)), batches, kind)
    load.full_load(spark, batches, merged, layout="hive")
    for kind in ("bills", "readings"):
        b = staging.bronze(spark, sf_dir, kind)
        export.export_tree(b.where(~staging.first_batch(kind)), batches, kind, mode="append")
    timed("incremental_merge", lambda: load.incremental_load(spark, batches, merged, layout="hive"))

    # a realistic increment: everything shipped before the last two months is
    # loaded, then the last two months arrive (all rows, split in time)
    last = standins.table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).collect()[0][0]
    cut = F.lit(f"{last.year}-{last.month:02d}-01").cast("timestamp_ntz") - F.expr("INTERVAL 1 MONTH")
    early = F.col("_ord.l_shipdate") < cut
    recent_tree, recent_target = f"{base}/recent", f"{base}/recent_silver"
    bb = staging.bronze(spark, sf_dir, "bills")
    export.export_tree(bb.where(early), recent_tree, "bills")
    load.full_load(spark, recent_tree, recent_target, kinds=["bills"], layout="hive")
    export.export_tree(bb.where(~early), recent_tree, "bills", mode="append")
    timed("incremental_last_months", lambda: load.incremental_load(
        spark, recent_tree, recent_target, kinds=["bills"], layout="hive"))

    bills = scan_silver(spark, silver, "bills")
    rd = scan_silver(spark, silver, "readings")
    meters = dims.meters_from_customers(spark, sf_dir)
    usage = billing.usage_rollup(rd)
    queries = {
        "revenue_by_division": lambda: run(reports.revenue_by_division(bills)),
        "consumption_by_subdivision": lambda: run(reports.consumption_by_subdivision(bills)),
        "top_consumers": lambda: run(reports.top_consumers(bills, 10)),
        "payment_status": lambda: run(reports.payment_status(bills)),
        "monthly_trend": lambda: run(reports.monthly_trend(bills, None)),
        "overview_bills": lambda: run(reports.overview(bills)),
        "voltage_quality": lambda: run(reports.voltage_quality(rd)),
        "flag_distribution": lambda: run(reports.flag_distribution(rd)),
        "validate_bills": lambda: run(quality.validate(bills, "bills")),
        "null_profile": lambda: run(quality.null_profile(bills)),
        "schema_profile": lambda: run(quality.schema_profile(bills.drop("etl_timestamp"))),
        "value_ranges": lambda: run(quality.value_ranges(bills)),
        "iqr_outliers": lambda: run(quality.iqr_outliers(rd)),
        "histogram": lambda: run(quality.histogram(bills, "total_amount", 50)),
        "box_stats": lambda: run(quality.box_stats(bills, "total_amount", ["division"])),
        "register_running_total": lambda: run(billing.running_total(
            rd, "meter_id", "timestamp", "consumption_kwh", "register_kwh")),
        "reading_anomalies": lambda: run(billing.reading_anomalies(rd)),
        "bill_charges": lambda: run(billing.bill_charges(usage, meters, dims.tariffs(spark))),
        "dedup_stand_in_bills": lambda: run(
            __import__("meterlake.catalog", fromlist=["x"]).silver_bills(spark, sf_dir)),
    }
    for name, fn in queries.items():
        timed(name, fn)

    from meterlake.operators.inventory import compression_ratio, layout_report
    from meterlake.plans import store
    saved = {r.data_type: r.space_saved_pct for r in compression_ratio(
        file_inventory(spark, tree, layout="hive"),
        {k: layout_report(spark, v.paths) for k, v in store.latest_versions(spark, silver).items()}).collect()}
    total = round(sum(v for k, v in times.items() if k != "export_bronze"), 3)
    mb = src_bytes / (1024 * 1024)
    out = {
        "metric": "total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "bronze_mb": round(mb, 2),
        "full_load_mb_per_s": round(mb / times["full_load"], 2) if times["full_load"] else None,
        "full_load_repeat_mb_per_s": round(mb / times["full_load_repeat"], 2),
        "space_saved_pct_snappy": saved,
        "rows": {"bills_silver": bills.count(), "readings_silver": rd.count(),
                 "lineitem": standins.table(spark, sf_dir, "lineitem").count()},
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
