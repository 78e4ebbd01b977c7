"""Dimension tables: tariffs (fixed), meters and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.billing import customer_id, meter_id
from meterlake.operators.joins import maybe_broadcast
from meterlake.schemas import TARIFF

INF = float("inf")

# The five tariffs (code, name, slabs as (upper kWh, rate),
# meter rent, service rent, GST rate).
TARIFFS = [
    ("A-1a(01)", "Residential Protected",
     [(50.0, 2.0), (100.0, 5.79), (200.0, 8.11), (300.0, 10.20), (700.0, 17.60), (INF, 20.0)],
     18.06, 13.85, 0.17),
    ("A-1a(02)", "Residential General",
     [(50.0, 2.0), (100.0, 5.79), (200.0, 8.11), (300.0, 10.20), (700.0, 17.60), (INF, 20.0)],
     18.06, 13.85, 0.17),
    ("A-1b(01)", "Residential Commercial", [(INF, 20.0)], 25.00, 15.50, 0.17),
    ("A-2a(01)", "Commercial Small", [(INF, 18.0)], 30.00, 18.00, 0.17),
    ("B-1(01)", "Industrial Small", [(INF, 16.0)], 50.00, 25.00, 0.17),
]


def tariffs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TARIFFS, TARIFF)


# Columns of the dimension tables.
METER_COLUMNS = ["meter_id", "division", "subdivision", "area", "meter_type", "tariff_code", "status"]
CUSTOMER_COLUMNS = ["customer_id", "meter_id", "name", "father_name", "address", "phone", "cnic", "payment_behavior"]


def read_dimension(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A stored dimension, all columns as text; one that the files lack is NULL."""
    return spark.read.schema(", ".join(f"`{c}` string" for c in columns)).parquet(path)


# Stand-in mapping of the test tables' market segment to a tariff.
SEGMENT_TARIFF = {
    "HOUSEHOLD": "A-1a(01)",
    "FURNITURE": "A-1a(02)",
    "BUILDING": "A-1b(01)",
    "AUTOMOBILE": "A-2a(01)",
    "MACHINERY": "B-1(01)",
}


def _segment_tariff(col: str):
    expr = None
    for seg, code in SEGMENT_TARIFF.items():
        expr = (F.when(F.col(col) == seg, code) if expr is None else expr.when(F.col(col) == seg, code))
    return expr.otherwise("A-1a(02)")


def meters_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """meters(meter_id, division, subdivision, area, meter_type,
    tariff_code, status) derived from the customer / nation / region tables."""
    base = sf_dir.rstrip("/")
    c = spark.read.parquet(f"{base}/customer.parquet")
    n = spark.read.parquet(f"{base}/nation.parquet")
    r = spark.read.parquet(f"{base}/region.parquet")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    j = c.join(maybe_broadcast(geo), c.c_nationkey == geo.n_nationkey)
    code = _segment_tariff("c_mktsegment")
    return j.select(
        meter_id("c_custkey").alias("meter_id"), F.col("r_name").alias("division"),
        F.col("n_name").alias("subdivision"), F.col("c_mktsegment").alias("area"),
        F.when(code.isin("A-2a(01)", "B-1(01)"), "Three Phase").otherwise("Single Phase").alias("meter_type"),
        code.alias("tariff_code"),
        F.when(F.col("c_acctbal") > 0, "Active").otherwise("Inactive").alias("status"))


def customers_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers with all columns, the personal ones invented from the key."""
    c = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    b, key = F.col("c_acctbal"), F.col("c_custkey")
    behaviour = (F.when(b < 0, "defaulter").when(b < 2000, "late_payer")
                 .when(b < 5000, "regular_payer").otherwise("prompt_payer"))
    digits = F.lpad(key.cast("string"), 7, "0")
    return c.select(
        customer_id("c_custkey").alias("customer_id"), meter_id("c_custkey").alias("meter_id"), F.col("c_name").alias("name"),
        F.concat(F.lit("Parent of "), F.col("c_name")).alias("father_name"),
        F.format_string("House %d, %s", key % 1000, "c_mktsegment").alias("address"),
        F.concat(F.lit("000-"), digits).alias("phone"), F.concat(F.lit("00000-"), digits, F.lit("-"), (key % 10).cast("string")).alias("cnic"),
        behaviour.alias("payment_behavior"))
