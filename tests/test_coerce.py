import math

from pyspark.sql import functions as F

from meterlake.functions.coerce import parse_month, parse_timestamp, to_double


def _one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


def test_numbers_strict(spark):
    got = _one(spark, ["abc", "5d", "1,000", "", "NA", "NaN", "nan", "null", " 7.5 ", "1e3",
                       "-2", ".5", "+3.", "inf"], to_double)
    assert got[:8] == [None] * 8
    assert got[8:13] == [7.5, 1000.0, -2.0, 0.5, 3.0]
    assert math.isinf(got[13])


def test_month(spark):
    got = _one(spark, ["2024-13", "2024-1", "2024-01", "2024-01x", "NA"], parse_month)
    assert got[0] is None and got[3] is None and got[4] is None
    assert got[1] == got[2]
    assert (got[1].year, got[1].month, got[1].day) == (2024, 1, 1)


def test_timestamp(spark):
    got = _one(spark, ["x", "2024", "2024-03-05 06:07:08", "2024-03-05"], parse_timestamp)
    assert got[0] is None and got[1] is None
    assert (got[2].hour, got[2].minute, got[2].second) == (6, 7, 8)
    assert got[3].hour == 0


def test_iso_timestamps(spark):
    texts = ["2024-01-01T05:06:07", "2024-01-01 05:06", "2024-01-01 05:06:07.25", "2024-01-01T05:06:07Z",
             "2024-01-01T05:06:07+05:00", "2024-01-01T05", "2024-01-01 05:06:07 x", "2024-01-0105:06"]
    got = _one(spark, texts, parse_timestamp)
    assert [(g.hour, g.minute) for g in got[:4]] == [(5, 6)] * 4 and got[2].microsecond == 250000
    assert (got[4].hour, got[4].minute) == (0, 6)
    assert got[5:] == [None, None, None]


def test_no_python_udf(spark):
    df = spark.createDataFrame([("1",)], "v string").select(to_double("v"), parse_month("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
