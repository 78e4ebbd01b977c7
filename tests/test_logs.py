from meterlake.operators import logs as log_ops
from meterlake.sources import logs as log_src


def _write(tmp_path, lines):
    p = tmp_path / "etl.log"
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(p)


LINES = [
    "2024-01-01 00:00:00 - INFO - start",
    "2024-01-01 00:00:01 - ERROR - read failed: INFO missing",
    "2024-01-01 00:00:02 - WARNING - slow file Bills",
    "garbage line",
    "2024-01-01 00:00:03 - INFO - done with bills",
]


def test_parse_and_level_counts(spark, tmp_path):
    parsed = log_src.parse_log(log_src.scan_log(spark, _write(tmp_path, LINES)))
    rows = parsed.collect()
    assert sum(1 for r in rows if r.level is None) == 1            # unparsed line kept
    counts = {r.level: (r.n_containing, r.n_parsed) for r in log_ops.log_level_counts(parsed).collect()}
    assert counts["INFO"] == (3, 2)                                # the ERROR line mentions INFO
    assert counts["ERROR"] == (1, 1) and counts["DEBUG"] == (0, 0)


def test_search_first_and_last(spark, tmp_path):
    lines = log_src.scan_log(spark, _write(tmp_path, LINES))
    last = [r.line for r in log_ops.log_search(lines, ["INFO", "WARNING"], "bills", 1, from_end=True).collect()]
    first = [r.line for r in log_ops.log_search(lines, ["INFO", "WARNING"], "BILLS", 1, from_end=False).collect()]
    assert last == [LINES[4]] and first == [LINES[2]]
    assert log_ops.log_search(lines, [], None, 10).count() == 0
