"""Bronze tree layout edge cases and the full / incremental / append loads."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from meterlake.plans import load, store
from meterlake.schemas import SILVER_BILLS
from meterlake.sources.bronze import read_bronze
from meterlake.sources.inventory import INVENTORY, file_inventory
from meterlake.sources.silver import scan_silver, scan_tolerant
from tests.conftest import BILL_HEADER, READING_HEADER, bill, reading, write_file


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "bronze"
    write_file(root, "RAWALPINDI", "TAXILA (RP SIDE)", "bills", BILL_HEADER,
               [bill("B1", kwh="10"), bill("B2", kwh="20"), bill("B1", kwh="99")])
    write_file(root, "ATTOCK", "A+B SUB", "bills", BILL_HEADER, [bill("B3", kwh="30")])
    # header order drift: meter_id first, bound by name
    drift = ["meter_id", "bill_id"] + BILL_HEADER[2:]
    write_file(root, "ATTOCK", "DRIFT", "bills", drift,
               [["000000000009", "B4", "2024-02", "40", "1", "1", "1", "5", "Late"]])
    # the same key in another subdivision: the first source_file wins
    write_file(root, "ZHOB", "LATER", "bills", BILL_HEADER, [bill("B2", kwh="777")])
    write_file(root, ".tmp", "X", "bills", BILL_HEADER, [bill("HIDDEN")])
    write_file(root, "ATTOCK", ".X", "bills", BILL_HEADER, [bill("B5", kwh="50")])
    write_file(root, "ATTOCK", "EMPTY", "bills", BILL_HEADER, [])
    write_file(root, "RAWALPINDI", "TAXILA (RP SIDE)", "readings", READING_HEADER,
               [reading("2024-01-01 00:00:00"), reading("2024-01-01 00:00:00", kwh="9"),
                reading("2024-01-01 01:00:00", volts="300")])
    return root


def test_inventory_paths(spark, tree):
    inv = file_inventory(spark, str(tree)).collect()
    subs = {(r.division, r.subdivision) for r in inv if r.data_type == "bills"}
    assert ("RAWALPINDI", "TAXILA (RP SIDE)") in subs
    assert ("ATTOCK", "A+B SUB") in subs
    assert ("ATTOCK", ".X") in subs                       # hidden subdivision is read
    assert not any(d.startswith(".") for d, _ in subs)    # hidden division is not
    src = {r.source_file for r in inv}
    assert "RAWALPINDI/TAXILA (RP SIDE)/bills/bills.tsv" in src


def test_scan_binds_by_name(spark, tree):
    inv = file_inventory(spark, str(tree), ["bills"])
    rows = {r.bill_id: r for r in read_bronze(spark, inv, "bills").collect()}
    assert rows["B4"].meter_id == "000000000009" and rows["B4"].status == "Late"
    assert rows["B3"].subdivision == "A+B SUB"
    assert "HIDDEN" not in rows


def test_full_load_semantics(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    res = load.full_load(spark, str(tree), target)
    bills = {r.bill_id: r for r in scan_silver(spark, target, "bills").collect()}
    assert bills["B1"].consumption_kwh == 10.0             # first copy in file order
    assert bills["B2"].consumption_kwh == 20.0             # first source file in path order
    assert set(bills) == {"B1", "B2", "B3", "B4", "B5"}
    assert bills["B1"].source_file == "RAWALPINDI/TAXILA (RP SIDE)/bills/bills.tsv"
    rd = scan_silver(spark, target, "readings").collect()
    assert len(rd) == 1 and rd[0].consumption_kwh == 1.5
    man = {r.path.split("/bronze/")[1]: r.records for r in store.committed_manifest(spark, target).collect()}
    assert man["ATTOCK/EMPTY/bills/bills.tsv"] == 0        # header-only file recorded
    assert man["ZHOB/LATER/bills/bills.tsv"] == 0          # its only row lost the key to B2
    assert res.tables["bills"]["files"] == 6


def test_unchanged_rerun_reads_nothing(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target)
    before = sorted(map(tuple, scan_silver(spark, target, "bills").drop("etl_timestamp").collect()))
    res = load.incremental_load(spark, str(tree), target)
    assert res.tables["bills"]["files"] == 0 and res.tables["readings"]["files"] == 0
    after = sorted(map(tuple, scan_silver(spark, target, "bills").drop("etl_timestamp").collect()))
    assert before == after


def test_changed_file_is_upserted(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target)
    p = tree / "ATTOCK" / "A+B SUB" / "bills" / "bills.tsv"
    time.sleep(1.1)
    with open(p, "a", encoding="utf-8") as fh:
        fh.write("\t".join(bill("B6", kwh="60")) + "\n")
    os.utime(p, None)
    # a conflicting key arrives in a new file: the new row wins
    write_file(tree, "ZHOB", "NEW", "bills", BILL_HEADER, [bill("B1", kwh="555")])
    res = load.incremental_load(spark, str(tree), target)
    assert res.tables["bills"]["files"] == 2
    bills = {r.bill_id: r.consumption_kwh for r in scan_silver(spark, target, "bills").collect()}
    assert bills["B6"] == 60.0 and bills["B3"] == 30.0 and bills["B1"] == 555.0
    assert len(bills) == 6
    again = load.incremental_load(spark, str(tree), target)
    assert again.tables["bills"]["files"] == 0


def test_append_load_adds_new_files_only(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target)
    write_file(tree, "ZHOB", "NEW", "bills", BILL_HEADER, [bill("B9", kwh="9")])
    res = load.append_load(spark, str(tree), target, kinds=["bills"])
    assert res.tables["bills"]["files"] == 1
    assert scan_silver(spark, target, "bills").count() == 6


def test_failure_before_commit_keeps_old_version(spark, tree, tmp_path, monkeypatch):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target)
    old = scan_silver(spark, target, "bills").count()
    old_manifest = store.committed_manifest(spark, target).count()
    write_file(tree, "ZHOB", "NEW", "bills", BILL_HEADER, [bill("B9", kwh="9")])

    def boom(*a, **k):
        raise RuntimeError("crash before commit")
    monkeypatch.setattr(store, "commit", boom)
    with pytest.raises(RuntimeError):
        load.incremental_load(spark, str(tree), target, kinds=["bills"])
    monkeypatch.undo()
    assert scan_silver(spark, target, "bills").count() == old
    assert store.committed_manifest(spark, target).count() == old_manifest
    # the interrupted run is redone cleanly
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    assert scan_silver(spark, target, "bills").count() == old + 1


def test_brotli_rejected(spark, tree, tmp_path):
    with pytest.raises(ValueError, match="zstd"):
        load.full_load(spark, str(tree), str(tmp_path / "s"), compression="brotli")


def test_zstd_and_gzip(spark, tree, tmp_path):
    for codec in ("zstd", "gzip"):
        t = str(tmp_path / codec)
        load.full_load(spark, str(tree), t, compression=codec, kinds=["bills"])
        assert scan_silver(spark, t, "bills").count() == 5


def test_tolerant_scan_reports_corrupt_part(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["bills"])
    v = store.latest_version(spark, target, "bills")
    part_dir = v.paths[0]
    good = spark.read.schema(SILVER_BILLS).parquet(part_dir).count()
    local = part_dir.split(":", 1)[1] if part_dir.startswith("file:") else part_dir
    with open(os.path.join(local, "part-99999-junk.parquet"), "wb") as fh:
        fh.write(b"not parquet at all")
    res = scan_tolerant(spark, part_dir, SILVER_BILLS)
    skipped = res.skipped.collect()
    assert good > 0 and res.data.count() == good
    assert len(skipped) == 1 and skipped[0].path.endswith("part-99999-junk.parquet") and skipped[0].rows_expected is None


def test_tolerant_scan_takes_parts_whole_or_not_at_all(spark, tmp_path):
    """A part damaged in its middle is out with all its rows, a valid empty one is in."""
    path = str(tmp_path / "parts")
    schema = spark.range(1).selectExpr("id", "cast(id AS string) AS s").schema
    for name, first, n in (("a", 0, 50_000), ("b", 50_000, 50_000), ("empty", 0, 0)):
        spark.range(first, first + n, 1, 1).selectExpr("id", "sha2(cast(id AS string), 256) AS s").write.parquet(f"{path}/{name}")
    part = next(f for f in (tmp_path / "parts" / "b").iterdir() if f.name.startswith("part-"))
    content = bytearray(part.read_bytes())
    middle = len(content) // 2
    content[middle:middle + 64] = bytes(64)
    part.write_bytes(content)
    for crc in (tmp_path / "parts" / "b").glob(".*.crc"):
        crc.unlink()
    res = scan_tolerant(spark, path, schema)
    assert res.data.count() == 50_000 and res.data.agg(F.max("id")).first()[0] == 49_999
    skipped = res.skipped.collect()
    assert [(r.rows_expected, r.rows_read < 50_000) for r in skipped] == [(50_000, True)] and "/b/" in skipped[0].path
    for f in (tmp_path / "parts" / "a").glob("part-*"):
        f.write_bytes(b"gone")
    for crc in (tmp_path / "parts" / "a").glob(".*.crc"):
        crc.unlink()
    assert scan_tolerant(spark, path, schema).data.count() == 0     # the empty part is whole
    for f in (tmp_path / "parts" / "empty").glob("part-*"):
        f.write_bytes(b"gone")
    for crc in (tmp_path / "parts" / "empty").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(ValueError, match="no whole"):
        scan_tolerant(spark, path, schema)


def test_manifest_written_after_data(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, now=dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc))
    m = store.committed_manifest(spark, target)
    assert m.where(F.col("records") > 0).count() >= 5


def test_upsert_rewrites_only_touched_months(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["bills"])
    before = store.latest_version(spark, target, "bills")
    assert len(before.paths) == 2                         # 2024-01 and 2024-02
    feb = [p for p in before.paths if p.endswith("_part=2024-02")]
    # new bill for January only: February's folder is carried over as is
    write_file(tree, "ZHOB", "NEW", "bills", BILL_HEADER, [bill("B7", kwh="7", month="2024-01")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    after = store.latest_version(spark, target, "bills")
    assert feb and feb[0] in after.paths
    assert scan_silver(spark, target, "bills").count() == 6


def test_upsert_finds_key_in_other_month(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["bills"])
    # B4 is stored under 2024-02; a corrected B4 arrives for 2024-01
    write_file(tree, "ZHOB", "FIX", "bills", BILL_HEADER, [bill("B4", kwh="44", month="2024-01")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    rows = [r for r in scan_silver(spark, target, "bills").collect() if r.bill_id == "B4"]
    assert len(rows) == 1 and rows[0].consumption_kwh == 44.0


def test_replace_by_source_drops_deleted_rows(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["bills"])
    time.sleep(1.1)
    # rewrite a file without B2 (and with a changed B1)
    write_file(tree, "RAWALPINDI", "TAXILA (RP SIDE)", "bills", BILL_HEADER, [bill("B1", kwh="11")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"], replace_by_source=True)
    got = {r.bill_id: r.consumption_kwh for r in scan_silver(spark, target, "bills").collect()}
    assert got["B1"] == 11.0 and "B2" not in got
    assert {"B3", "B4", "B5"} <= set(got)


def test_load_statistics_and_cli(spark, tree, tmp_path, capsys):
    from meterlake.__main__ import main
    from meterlake.plans.stats import load_statistics
    target = str(tmp_path / "silver")
    main(["incremental", "--source", str(tree), "--target", target])
    stats = {r.table_name: r for r in load_statistics(spark, target).collect()}
    assert stats["bills"].n_rows == 5 and stats["bills"].size_mb > 0
    assert stats["bills"].last_incremental_load is not None and stats["bills"].last_full_load is None
    main(["report", "revenue", "--target", target])
    assert "TOTAL" in capsys.readouterr().out


def test_scan_silver_prunes_months(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["bills"])
    feb = scan_silver(spark, target, "bills", start="2024-02-01", end="2024-03-01")
    assert [r.bill_id for r in feb.collect()] == ["B4"]
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "_part=2024-01" not in plan                    # January's folder is not scanned
    assert "PushedFilters" in plan and "billing_month" in plan


def test_vanished_file_is_skipped(spark, tree, tmp_path):
    from meterlake.plans.load import frozen_inventory
    inv = frozen_inventory(spark, str(tree), ["bills"], "tree")
    gone = tree / "ZHOB" / "LATER" / "bills" / "bills.tsv"
    os.remove(gone)                                   # listed, then vanished before the scan
    rows = read_bronze(spark, inv, "bills").collect()
    assert all(r.subdivision != "LATER" for r in rows) and len(rows) >= 5


def test_glob_characters_in_roots(spark, tmp_path):
    src = tmp_path / "bronze [v1] {a}"
    write_file(src, "D [x]", "S{1}", "bills", BILL_HEADER, [bill("G1"), bill("G2", month="2024-02")])
    target = str(tmp_path / "silver [v1]")
    load.full_load(spark, str(src), target, kinds=["bills"])
    write_file(src, "D [x]", "S{2}", "bills", BILL_HEADER, [bill("G1", kwh="5")])
    load.incremental_load(spark, str(src), target, kinds=["bills"])
    got = {r.bill_id: (r.consumption_kwh, r.division) for r in scan_silver(spark, target, "bills").collect()}
    assert got == {"G1": (5.0, "D [x]"), "G2": (100.0, "D [x]")}


def test_underscore_division_is_read(spark, tmp_path):
    src = tmp_path / "bronze"
    write_file(src, "_ARCHIVE", "S1", "bills", BILL_HEADER, [bill("U1")])
    write_file(src, "NORMAL", "S1", "bills", BILL_HEADER, [bill("U2")])
    inv = {r.division for r in file_inventory(spark, str(src), ["bills"]).collect()}
    assert inv == {"_ARCHIVE", "NORMAL"}
    load.full_load(spark, str(src), str(tmp_path / "silver"), kinds=["bills"])
    got = {r.bill_id for r in scan_silver(spark, str(tmp_path / "silver"), "bills").collect()}
    assert got == {"U1", "U2"}


def test_manifest_reads_since_last_full_load(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["bills"])
    write_file(tree, "ZHOB", "NEW", "bills", BILL_HEADER, [bill("B8")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    load.full_load(spark, str(tree), target, kinds=["bills"])
    m = store.committed_manifest(spark, target)
    runs = [r.run_id for r in store.commits(spark, target).orderBy("committed_at").collect()]
    files = m.inputFiles()
    assert files and all(f"/_manifest/{runs[-1]}/" in f for f in files)   # older runs not read
    assert m.count() == 7 and m.where(F.col("run_id") != runs[-1]).count() == 0


def test_unreadable_header_stops_a_strict_load(spark, tree, tmp_path, monkeypatch):
    from meterlake.sources import bronze

    def no_access(uri, limit=1 << 20):
        raise PermissionError("no credentials here")
    monkeypatch.setattr(bronze, "_first_line", no_access)
    with pytest.raises(bronze.UnreadableHeader, match="no credentials"):
        load.full_load(spark, str(tree), str(tmp_path / "silver"), kinds=["bills"], strict=True)


def test_bad_files_are_rejected_and_the_others_loaded(spark, tree, tmp_path):
    from meterlake.sources import bronze

    target = str(tmp_path / "silver")
    write_file(tree, "ZHOB", "WIDE", "bills", ["x" * (bronze.HEADER_BYTES + 1)], [])
    short = write_file(tree, "ZHOB", "SHORT", "bills", ["bill_id", "meter_id"], [["S1", "1"]])
    with pytest.raises(bronze.UnreadableHeader, match="first line|missing columns"):
        load.full_load(spark, str(tree), target, kinds=["bills"], strict=True)
    res = load.full_load(spark, str(tree), target, kinds=["bills"])
    assert res.rejected == 2 and res.tables["bills"]["files"] == 6
    assert {r.bill_id for r in scan_silver(spark, target, "bills").collect()} == {"B1", "B2", "B3", "B4", "B5"}
    why = {r.path.split("/bronze/")[1]: r.reason for r in store.load_rejects(spark, target, res.run_id).collect()}
    assert why["ZHOB/SHORT/bills/bills.tsv"] == "missing columns: consumption_kwh, total_amount"
    assert "first line" in why["ZHOB/WIDE/bills/bills.tsv"]
    assert not {p for p in why} & {r.path.split("/bronze/")[1] for r in store.committed_manifest(spark, target).collect()}
    # a mended file is picked up by the next load, the other one is tried again
    short.unlink()
    write_file(tree, "ZHOB", "SHORT", "bills", BILL_HEADER, [bill("S1")])
    again = load.incremental_load(spark, str(tree), target, kinds=["bills"])
    assert again.rejected == 1 and again.tables["bills"]["files"] == 1
    assert "S1" in {r.bill_id for r in scan_silver(spark, target, "bills").collect()}
    assert store.load_rejects(spark, target).count() == 3


def test_upsert_after_append_keeps_one_row_per_key(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["readings"])
    write_file(tree, "ZHOB", "APP", "readings", READING_HEADER, [reading("2024-01-01 05:00:00", meter="9", kwh="1.0")])
    load.append_load(spark, str(tree), target, kinds=["readings"])
    write_file(tree, "ZHOB", "APP", "readings", READING_HEADER, [reading("2024-01-01 05:00:00", meter="9", kwh="9.25")])
    load.incremental_load(spark, str(tree), target, kinds=["readings"])
    rows = [r for r in scan_silver(spark, target, "readings").collect() if r.meter_id == "9"]
    assert [r.consumption_kwh for r in rows] == [9.25]


def test_commits_are_ordered_whatever_the_clocks_say(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target, kinds=["bills"], now=dt.datetime(2031, 1, 1, tzinfo=dt.timezone.utc))
    write_file(tree, "ZHOB", "LATE", "bills", BILL_HEADER, [bill("LATE1")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"], now=dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    assert "LATE1" in {r.bill_id for r in scan_silver(spark, target, "bills").collect()}
    assert load.incremental_load(spark, str(tree), target, kinds=["bills"]).tables["bills"]["files"] == 0


def test_the_manifest_of_one_table_outlives_loads_of_the_other(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    load.full_load(spark, str(tree), target)
    write_file(tree, "ZHOB", "MORE", "bills", BILL_HEADER, [bill("M1")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    load.full_load(spark, str(tree), target, kinds=["bills"])
    assert load.incremental_load(spark, str(tree), target).tables["readings"]["files"] == 0
    assert scan_silver(spark, target, "readings").count() == 1


def test_a_vanished_file_is_loaded_when_it_returns(spark, tree, tmp_path):
    target = str(tmp_path / "silver")
    path = write_file(tree, "ZHOB", "GONE", "bills", BILL_HEADER, [bill("GONE1")])
    kept = path.read_text()
    rows = file_inventory(spark, str(tree), ["bills"]).collect()
    path.unlink()                        # between the listing and the read
    load.load_files(spark, spark.createDataFrame(rows, INVENTORY), target, "full", ["bills"], "tree")
    assert not [r for r in store.committed_manifest(spark, target).collect() if "GONE" in r.path]
    path.write_text(kept)
    stamp = next(r.modified for r in rows if "GONE" in r.path).timestamp()
    os.utime(path, (stamp, stamp))       # same length and time as listed
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    assert "GONE1" in {r.bill_id for r in scan_silver(spark, target, "bills").collect()}


def test_a_missing_manifest_folder_is_an_error(spark, tree, tmp_path):
    import shutil

    target = tmp_path / "silver"
    load.full_load(spark, str(tree), str(target), kinds=["bills"])
    shutil.rmtree(target / "_manifest")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load.append_load(spark, str(tree), str(target), kinds=["bills"])


def test_replaced_and_unfinished_folders_go_with_the_next_load(spark, tree, tmp_path, monkeypatch):
    from meterlake.operators.inventory import layout_report

    target = tmp_path / "silver"

    def size():
        paths = store.latest_version(spark, str(target), "bills").paths
        return layout_report(spark, paths).agg({"bytes": "sum"}).first()[0]

    def boom(*a, **k):
        raise RuntimeError("crash before commit")
    load.full_load(spark, str(tree), str(target), kinds=["bills"])
    first, rows = size(), scan_silver(spark, str(target), "bills").count()
    reader = scan_silver(spark, str(target), "bills")
    load.full_load(spark, str(tree), str(target), kinds=["bills"])
    assert reader.count() == rows                 # a reader that began before the load still reads
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(store, "commit", boom)
        load.full_load(spark, str(tree), str(target), kinds=["bills"])
    load.full_load(spark, str(tree), str(target), kinds=["bills"])
    assert len(list((target / "bills").iterdir())) == 2       # the newest and the one it replaced
    assert abs(size() - first) < 0.05 * first and scan_silver(spark, str(target), "bills").count() == rows


def test_staging_is_removed_and_the_zone_does_not_matter(spark, tree, tmp_path):
    target = tmp_path / "silver"
    spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
    try:
        load.full_load(spark, str(tree), str(target), kinds=["bills"])
        write_file(tree, "ZHOB", "ZONE", "bills", BILL_HEADER, [bill("ZONE1", month="2024-03")])
        load.incremental_load(spark, str(tree), str(target), kinds=["bills"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert not (target / "_staging").exists() or not list((target / "_staging").glob("*"))
    assert [r.billing_month.month for r in scan_silver(spark, str(target), "bills").collect() if r.bill_id == "ZONE1"] == [3]


def test_collision_scan_with_null_key_and_key_list(spark, tree, tmp_path, monkeypatch):
    target = str(tmp_path / "silver")
    write_file(tree, "ZHOB", "NULLKEY", "bills", BILL_HEADER, [bill("", kwh="1", month="2024-02")])
    load.full_load(spark, str(tree), target, kinds=["bills"])
    # the NULL-key bill (stored under 2024-02) is replaced by a new NULL-key bill in 2024-01
    write_file(tree, "ZHOB", "NULLKEY2", "bills", BILL_HEADER, [bill("NA", kwh="2", month="2024-01")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    nulls = [r.consumption_kwh for r in scan_silver(spark, target, "bills").collect() if r.bill_id is None]
    assert nulls == [2.0]
    # the same through the join path (key list disabled)
    monkeypatch.setattr(load, "KEY_LIST_MAX", 0)
    write_file(tree, "ZHOB", "FIX4", "bills", BILL_HEADER, [bill("B4", kwh="45", month="2024-01")])
    load.incremental_load(spark, str(tree), target, kinds=["bills"])
    b4 = [r.consumption_kwh for r in scan_silver(spark, target, "bills").collect() if r.bill_id == "B4"]
    assert b4 == [45.0]


def test_export_rejects_bad_column_list(spark, tmp_path):
    from meterlake.plans import export
    df = spark.createDataFrame([("B1", "D", "S", 1)], "bill_id string, division string, subdivision string, i long")
    with pytest.raises(ValueError, match="permutation"):
        export.export_tree(df.withColumn("_ord", F.struct("i")), str(tmp_path / "x"), "bills",
                           columns=["bill_id"])


def test_cli_validate_with_coverage(spark, tree, tmp_path, capsys):
    from meterlake.__main__ import main
    target = str(tmp_path / "silver")
    main(["full", "--source", str(tree), "--target", target])
    main(["validate", "--target", target, "--compare-source", str(tree)])
    out = capsys.readouterr().out
    assert "duplicates:bill_id" in out and "pct_covered" in out
