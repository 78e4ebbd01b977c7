import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from meterlake.functions import billing as fb
from meterlake.operators import billing
from meterlake.sources import dimensions as dims


def test_slab_charge_progressive(spark):
    t = dims.tariffs(spark).where(F.col("tariff_code") == "A-1a(01)")
    rows = t.select(*[fb.slab_charge(F.lit(k), "rates").alias(f"k{int(k)}") for k in (0.0, 50.0, 120.0, 900.0)]).collect()[0]
    assert rows.k0 == 0.0 and rows.k50 == 100.0
    assert abs(rows.k120 - (50 * 2.0 + 50 * 5.79 + 20 * 8.11)) < 1e-9
    want = 50 * 2.0 + 50 * 5.79 + 100 * 8.11 + 100 * 10.20 + 400 * 17.60 + 200 * 20.0
    assert abs(rows.k900 - want) < 1e-9


def test_tariff_class_first_match(spark):
    df = spark.createDataFrame([("Residential Commercial",), ("Commercial Small",), ("Industrial Small",)], "n string")
    assert [r[0] for r in df.select(fb.tariff_class("n")).collect()] == ["Residential", "Commercial", "Industrial"]


def _readings(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    for m in ("M1", "M2"):
        for h in range(0, 72, 1 if m == "M1" else 5):
            if m == "M1" and h in (30, 31):
                continue
            kwh = 0.0 if h == 10 else (50.0 if h == 40 else 1.0 + h % 3)
            rows.append((m, base + dt.timedelta(hours=h), kwh))
    return spark.createDataFrame(rows, "meter_id string, timestamp timestamp, consumption_kwh double")


def test_running_total_matches_pandas(spark):
    r = _readings(spark)
    got = billing.running_total(r, "meter_id", "timestamp", "consumption_kwh", "reg").toPandas()
    pdf = r.toPandas().sort_values(["meter_id", "timestamp"])
    pdf["reg"] = pdf.groupby("meter_id")["consumption_kwh"].cumsum()
    m = pdf.merge(got, on=["meter_id", "timestamp"], suffixes=("", "_got"))
    assert len(m) == len(pdf)
    assert (abs(m["reg"] - m["reg_got"]) < 1e-9).all()


def test_anomalies_match_pandas(spark):
    r = _readings(spark)
    got = billing.reading_anomalies(r, spike=5.0, only_flagged=False).toPandas()
    pdf = r.toPandas().sort_values(["meter_id", "timestamp"])
    gap = pdf.groupby("meter_id")["timestamp"].diff().dt.total_seconds() / 3600
    mean = pdf.groupby("meter_id")["consumption_kwh"].transform("mean")
    pdf["is_gap"] = (gap > 1).fillna(False)
    pdf["is_spike"] = pdf["consumption_kwh"] >= 5 * mean
    m = pdf.merge(got, on=["meter_id", "timestamp"], suffixes=("", "_got"))
    assert len(m) == len(pdf)
    assert (m["is_gap"] == m["is_gap_got"]).all()
    assert (m["is_spike"] == m["is_spike_got"]).all()
    assert m.loc[m["consumption_kwh"] == 0, "is_zero"].all()
    assert isinstance(pdf, pd.DataFrame)


def test_ids(spark):
    df = spark.createDataFrame([(42, 3)], "n long, m int")
    r = df.select(fb.meter_id("n").alias("a"), fb.customer_id("n").alias("b"),
                  fb.bill_id(fb.meter_id("n"), "m").alias("c")).collect()[0]
    assert (r.a, r.b, r.c) == ("000000000042", "CUST00000042", "BILL00000000004203")
