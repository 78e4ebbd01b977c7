"""Profiles: distincts without expansion, histograms with infinities, odd tables."""

import datetime as dt
import math

import pytest

from meterlake.operators import distincts, quality, reports

INF = float("inf")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", 0.0, dt.datetime(2024, 1, 1), [1, 2], b"x", 1), ("a", -0.0, None, [1, 2], b"y", 1), (None, float("nan"), dt.datetime(2024, 1, 2), None, None, None),
            ("", 1.5, dt.datetime(2024, 1, 2), [2, 1], b"x", 2), ("b", None, dt.datetime(2024, 1, 3), [], b"", 3)]
    return spark.createDataFrame(rows, "s string, d double, t timestamp, l array<int>, b binary, i long")


def test_schema_profile_counts_every_type(table):
    got = {r.column: (r.non_null, r.nulls, r.n_unique) for r in quality.schema_profile(table).collect()}
    assert got == {"s": (4, 1, 3), "d": (4, 1, 3), "t": (4, 1, 3), "l": (4, 1, 3), "b": (4, 1, 3), "i": (4, 1, 3)}


def test_an_empty_table_is_profiled(table):
    none = table.where("false")
    assert {tuple(r)[2:] for r in quality.schema_profile(none).collect()} == {(0, 0, 0)}
    one = distincts.with_distincts(none, ["s", "i"], {"n": ("sum", distincts.F.lit(1))}).collect()
    assert [tuple(r) for r in one] == [(None, 0, 0)]


def test_distincts_are_not_planned_as_an_expansion(spark, table):
    bills = table.selectExpr("s AS meter_id", "s AS division", "i AS subdivision", "t AS billing_month", "d AS consumption_kwh", "d AS total_amount", "s AS bill_id")
    for df in (quality.schema_profile(table), reports.overview(bills), quality.validate(bills, "bills"),
               reports.table_statistics(bills, "bills", "billing_month")):
        assert "Expand" not in plan_of(df)
    one = reports.overview(bills).collect()[0]
    assert tuple(one) == (5, 3, 3, 3)
    checks = {r.check: r.value for r in quality.validate(bills, "bills").collect()}
    assert checks["rows"] == 5 and checks["nulls:meter_id"] == 1 and checks["distinct:meter_id"] == 3 and checks["missing_columns"] == 6


def test_a_hot_value_is_one_row_per_task(spark):
    df = spark.range(100_000).selectExpr("id % 3 AS a", "case when id % 3 = 0 then 'hot' else cast(id AS string) end AS b")
    got = {r.column: r.n_unique for r in quality.schema_profile(df).collect()}
    assert got == {"a": 3, "b": 66_667}


def test_histogram_keeps_infinities_apart(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(INF,)] * 4 + [(-INF,)] * 2 + [(None,), (float("nan"),)], "x double")
    rows = quality.histogram(df, "x", bins=5).collect()
    assert [(r.bin, r.n) for r in rows] == [(-1, 2), (0, 2), (1, 2), (2, 2), (3, 2), (4, 2), (5, 4)]
    assert rows[0].upper == 0.0 and rows[-1].lower == 9.0 and rows[-1].upper == INF and rows[1].upper == 1.8
    only = quality.histogram(spark.createDataFrame([(INF,), (INF,)], "x double"), "x").collect()
    assert [(r.bin, r.n) for r in only] == [(50, 2)]
    assert quality.histogram(spark.createDataFrame([(None,)], "x double"), "x").count() == 0


def test_histogram_of_one_value_and_of_a_wide_span(spark):
    same = quality.histogram(spark.createDataFrame([(3.0,)] * 7, "x double"), "x", bins=4).collect()
    assert [r.n for r in same] == [7, 0, 0, 0]
    big = quality.histogram(spark.createDataFrame([(-1.7e308,), (0.0,), (1.7e308,)], "x double"), "x", bins=2).collect()
    assert [r.n for r in big] == [1, 2] and not math.isnan(big[0].upper)
