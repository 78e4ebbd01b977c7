from meterlake.plans import store
from meterlake.sources.silver import scan_silver
from meterlake.streaming.ingest import ingest_changed, stream_ingest, watch_changes
from tests.conftest import BILL_HEADER, bill, write_file


def _run(spark, src, target, ckpt):
    for q in stream_ingest(spark, str(src), target, ckpt, ["bills"]):
        q.awaitTermination()


def test_available_now_twice_is_stable_and_picks_new_files(spark, tmp_path):
    src = tmp_path / "bronze"
    write_file(src, "D1", "S1", "bills", BILL_HEADER, [bill("B1"), bill("B2", amount="0")])
    target, ckpt = str(tmp_path / "silver"), str(tmp_path / "ckpt")
    _run(spark, src, target, ckpt)
    first = sorted(r.bill_id for r in scan_silver(spark, target, "bills").collect())
    assert first == ["B1"]
    _run(spark, src, target, ckpt)                    # nothing new: no new commit
    assert store.commits(spark, target).count() == 1
    write_file(src, "D1", "S2", "bills", BILL_HEADER, [bill("B1", kwh="7"), bill("B3")])
    _run(spark, src, target, ckpt)
    got = {r.bill_id: r.consumption_kwh for r in scan_silver(spark, target, "bills").collect()}
    assert got == {"B1": 7.0, "B3": 100.0}             # newer file wins for B1


def test_both_tables_stream_into_one_target(spark, tmp_path):
    from tests.conftest import READING_HEADER, reading
    src = tmp_path / "bronze"
    write_file(src, "D1", "S1", "bills", BILL_HEADER, [bill("B1"), bill("B2")])
    write_file(src, "D1", "S1", "readings", READING_HEADER,
               [reading("2024-01-01 00:00:00"), reading("2024-01-01 01:00:00", volts="999")])
    target = str(tmp_path / "silver")
    for q in stream_ingest(spark, str(src), target, str(tmp_path / "ckpt")):
        q.awaitTermination()
    assert scan_silver(spark, target, "bills").count() == 2
    assert scan_silver(spark, target, "readings").count() == 1
    kinds = {r.data_type for r in store.commits(spark, target).collect()}
    assert kinds == {"bills", "readings"}


def test_changed_files_are_polled_after_a_stream(spark, tmp_path):
    """The file stream never reads a known path again; the poll does."""
    src = tmp_path / "bronze"
    path = write_file(src, "D1", "S1", "bills", BILL_HEADER, [bill("B1"), bill("B2")])
    target, ckpt = str(tmp_path / "silver"), str(tmp_path / "ckpt")
    _run(spark, src, target, ckpt)
    path.write_text(path.read_text().replace("B2", "B2x") + "\t".join(bill("B3", kwh="3")) + "\n")
    _run(spark, src, target, ckpt)
    assert {r.bill_id for r in scan_silver(spark, target, "bills").collect()} == {"B1", "B2"}
    assert ingest_changed(spark, str(src), target, ["bills"]).tables["bills"]["files"] == 1
    got = [r.bill_id for r in scan_silver(spark, target, "bills").collect()]
    assert sorted(got) == ["B1", "B2", "B2x", "B3"]           # one row per key; stored rows stay
    assert ingest_changed(spark, str(src), target, ["bills"]).tables["bills"]["files"] == 0
    path.write_text(path.read_text() + "\t".join(bill("B4")) + "\n")
    ingest_changed(spark, str(src), target, ["bills"], replace_by_source=True)
    assert sorted(r.bill_id for r in scan_silver(spark, target, "bills").collect()) == ["B1", "B2x", "B3", "B4"]


def test_a_watch_polls_in_its_micro_batches(spark, tmp_path):
    src = tmp_path / "bronze"
    path = write_file(src, "D1", "S1", "bills", BILL_HEADER, [bill("B1")])
    target, ckpt = str(tmp_path / "silver"), str(tmp_path / "ckpt")

    def tick():
        watch_changes(spark, str(src), target, ckpt, ["bills"], available_now=True).awaitTermination()
    tick()
    assert [r.bill_id for r in scan_silver(spark, target, "bills").collect()] == ["B1"]
    path.write_text(path.read_text() + "\t".join(bill("B2")) + "\n")
    tick()
    assert sorted(r.bill_id for r in scan_silver(spark, target, "bills").collect()) == ["B1", "B2"]
    assert store.commits(spark, target).count() == 2
