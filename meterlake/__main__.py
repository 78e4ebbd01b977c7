"""Command line: ``python -m meterlake <command> ...``

full         load every file of a bronze tree into a target
incremental  load new and changed files (keyed upsert)
append       load files never seen before (no cross-batch dedup)
stats        rows, distincts, time range, size and last loads of a target
validate     validation report of each table (optionally source coverage)
report       one explorer report (revenue, consumption, top, status, voltage, trend)
stream       continuous ingestion (Structured Streaming)
"""

from __future__ import annotations

import argparse

from meterlake.session import build_session


def _loads(sub):
    for name in ("full", "incremental", "append"):
        p = sub.add_parser(name)
        p.add_argument("--source", required=True)
        p.add_argument("--target", required=True)
        p.add_argument("--compression", default="snappy")
        p.add_argument("--layout", default="tree", choices=["tree", "hive"])
        p.add_argument("--kinds", default="bills,readings")
        if name == "incremental":
            p.add_argument("--replace-by-source", action="store_true")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="meterlake")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    _loads(sub)
    st = sub.add_parser("stats")
    st.add_argument("--target", required=True)
    va = sub.add_parser("validate")
    va.add_argument("--target", required=True)
    va.add_argument("--compare-source", default=None)
    va.add_argument("--layout", default="tree", choices=["tree", "hive"])
    qu = sub.add_parser("quality")
    qu.add_argument("--target", required=True)
    qu.add_argument("--kinds", default="bills,readings")
    rj = sub.add_parser("rejects")
    rj.add_argument("--target", required=True)
    rp = sub.add_parser("report")
    rp.add_argument("name", choices=["revenue", "consumption", "top", "status", "voltage", "trend",
                                     "overview"])
    rp.add_argument("--target", required=True)
    rp.add_argument("--division", default=None)
    rp.add_argument("--year", type=int, default=None)
    rp.add_argument("-n", type=int, default=10)
    sm = sub.add_parser("stream")
    sm.add_argument("--source", required=True)
    sm.add_argument("--target", required=True)
    sm.add_argument("--checkpoint", required=True)
    sm.add_argument("--layout", default="tree", choices=["tree", "hive"])
    sm.add_argument("--every", default=None, help="processing-time trigger, e.g. '60 minutes'")
    a = ap.parse_args(argv)

    spark = build_session(master=a.master)
    if a.cmd in ("full", "incremental", "append"):
        from meterlake.plans import load
        kinds = [k for k in a.kinds.split(",") if k]
        fn = {"full": load.full_load, "incremental": load.incremental_load,
              "append": load.append_load}[a.cmd]
        extra = {"replace_by_source": a.replace_by_source} if a.cmd == "incremental" else {}
        res = fn(spark, a.source, a.target, kinds=kinds, layout=a.layout,
                 compression=a.compression, **extra)
        print(res)
    elif a.cmd == "stats":
        from meterlake.plans.stats import load_statistics
        load_statistics(spark, a.target).show(truncate=False)
    elif a.cmd == "validate":
        from meterlake.operators import quality
        from meterlake.sources.silver import scan_silver
        silver = {k: scan_silver(spark, a.target, k) for k in ("bills", "readings")}
        for k, df in silver.items():
            quality.validate(df, k).show(50, truncate=False)
        if a.compare_source:
            from meterlake.operators.inventory import coverage_summary, source_coverage
            from meterlake.sources.inventory import file_inventory
            inv = file_inventory(spark, a.compare_source, layout=a.layout)
            coverage_summary(source_coverage(inv, silver)).show(truncate=False)
    elif a.cmd == "quality":
        from meterlake.operators import quality
        from meterlake.sources.silver import scan_silver
        for kind in a.kinds.split(","):
            quality.quality_report(scan_silver(spark, a.target, kind), kind).show(200, truncate=False)
    elif a.cmd == "rejects":
        from meterlake.plans import store
        store.load_rejects(spark, a.target).orderBy("run_id", "path").show(1000, truncate=False)
    elif a.cmd == "report":
        from meterlake.operators import reports
        from meterlake.sources.silver import scan_silver
        if a.name == "trend" and a.year is not None:
            # only that year's month folders are read
            bills = scan_silver(spark, a.target, "bills", start=f"{a.year}-01-01",
                                end=f"{a.year + 1}-01-01")
        else:
            bills = scan_silver(spark, a.target, "bills")
        out = {
            "revenue": lambda: reports.revenue_by_division(bills),
            "consumption": lambda: reports.consumption_by_subdivision(bills, a.division),
            "top": lambda: reports.top_consumers(bills, a.n),
            "status": lambda: reports.payment_status(bills),
            "voltage": lambda: reports.voltage_quality(scan_silver(spark, a.target, "readings")),
            "trend": lambda: reports.monthly_trend(bills, a.year),
            "overview": lambda: reports.overview(bills),
        }[a.name]()
        out.show(100, truncate=False)
    elif a.cmd == "stream":
        from meterlake.streaming.ingest import stream_ingest
        qs = stream_ingest(spark, a.source, a.target, a.checkpoint, layout=a.layout,
                           available_now=a.every is None, processing_time=a.every or "60 minutes")
        for q in qs:
            q.awaitTermination()


if __name__ == "__main__":
    main()
