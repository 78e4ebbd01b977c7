from pyspark.sql import functions as F

from meterlake import catalog
from meterlake.operators import quality, reports

SF = "/root/testdata/sf0.001"


def test_revenue_total_row(spark):
    r = reports.revenue_by_division(catalog.silver_bills(spark, SF)).collect()
    total = [x for x in r if x.division == "TOTAL"][0]
    parts = [x for x in r if x.division != "TOTAL"]
    assert abs(sum(x.revenue for x in parts) - total.revenue) < 0.05
    assert abs(sum(x.pct for x in parts) - 100) < 0.01
    assert r[-1].division == "TOTAL"


def test_histogram_bins_sum_to_rows(spark):
    b = catalog.silver_bills(spark, SF)
    h = quality.histogram(b, "total_amount", 20).collect()
    assert len(h) == 20
    assert sum(x.n for x in h) == b.where(F.col("total_amount").isNotNull()).count()


def test_top_consumers_ranked(spark):
    t = reports.top_consumers(catalog.silver_bills(spark, SF), 5).collect()
    assert [x["rank"] for x in t] == [1, 2, 3, 4, 5]
    assert all(t[i].total_kwh >= t[i + 1].total_kwh for i in range(4))


def test_monthly_trend_year_filter_pushed(spark):
    df = reports.monthly_trend(catalog.silver_bills(spark, SF), 1996)
    assert {r.year for r in df.collect()} == {1996}


def test_voltage_quality_exact(spark):
    r = catalog.silver_readings(spark, SF)
    v = reports.voltage_quality(r).collect()[0]
    assert v.n_low + v.n_normal + v.n_high == r.count()


def test_validate_flags(spark):
    rep = {x.check: x for x in quality.validate(catalog.silver_bills(spark, SF), "bills").collect()}
    assert rep["missing_columns"].status == "ok"
    assert rep["rule:total_amount<=0"].value == 0
    assert rep["duplicates:bill_id"].status == "ok"


def test_schema_profile_counts(spark):
    b = catalog.silver_bills(spark, SF).select("bill_id", "total_amount")
    prof = {x.column: x for x in quality.schema_profile(b).collect()}
    n = b.count()
    assert prof["bill_id"].non_null + prof["bill_id"].nulls == n
    assert prof["total_amount"].dtype == "double"


def test_all_null_group_sums_to_zero(spark):
    df = spark.createDataFrame(
        [("B1", "Paid", 5.0, "D1", "S1", 2.0), ("B2", "Late", None, "D1", "S2", None)],
        "bill_id string, status string, total_amount double, division string, subdivision string, "
        "consumption_kwh double")
    st = {r.status: r.amount for r in reports.payment_status(df).collect()}
    assert st["Late"] == 0.0 and st["TOTAL"] == 5.0
    sub = {r.subdivision: r.consumption_kwh for r in reports.consumption_by_subdivision(df, "d1").collect()}
    assert sub["S2"] == 0.0
