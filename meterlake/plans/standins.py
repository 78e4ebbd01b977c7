"""Bronze bills / readings derived from the shared test tables.

The engine's real input is a tree of text files.  For the registered queries
we derive the same bronze *text* rows from the star-schema tables so that
every query reads whole tables and its work grows with them:

bills    one row per ``lineitem`` row (joined to orders, customer, nation,
         region).  ``(l_orderkey, l_linenumber)`` repeats, so the key
         de-duplication matters; customers with a non-positive balance give
         non-positive amounts, so the amount filter matters.
readings one row per ``events`` row; the timestamp is truncated to the hour so
         (timestamp, meter) repeats; voltage spans 170..269 so both range
         limits bite; consumption ``value - 5`` is sometimes negative.

Deterministic faults are written into the text (by key residue, every row is
kept) so the strict parsing rules are exercised: ``abc``, ``5d``, empty,
``NA``, ``NaN``, a month ``2024-13`` and unparseable timestamps.

``_ord`` is the stand-in for file order: source file first, then the
remaining raw columns so the order is total and reproducible in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators.joins import maybe_broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _num_text(value: Column) -> Column:
    return value.cast("double").cast("string")


def bills_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows that ``bills_text`` makes bills of: the numbers, division,
    subdivision and ``_ord`` without the source file, which those two name."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    # orders -> customer first: the smaller side is shuffled by custkey, then
    # the (orders-sized) result meets lineitem on the order key.
    cust = cust.join(maybe_broadcast(geo), cust.c_nationkey == geo.n_nationkey)
    owner = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        "o_orderkey", "o_custkey", "c_acctbal", "n_name", "r_name")
    j = li.join(owner, li.l_orderkey == owner.o_orderkey)
    return j.select(
        "l_orderkey", "l_linenumber", "o_custkey", F.signum("c_acctbal").alias("sign"),
        F.col("r_name").alias("division"), F.col("n_name").alias("subdivision"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus").alias("_ord"))


def bills_text(rows: DataFrame) -> DataFrame:
    """Bronze bills of ``bills_rows``."""
    k = F.col("l_orderkey")
    numbers = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
               "l_tax", "l_returnflag", "l_linestatus"]
    rows = rows.select("l_orderkey", "l_linenumber", "o_custkey", "sign", "division", "subdivision", "_ord.*")
    amount = (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
              * F.col("sign"))
    source_file = F.concat_ws("/", "division", "subdivision", F.lit("bills"), F.lit("bills.tsv"))
    return rows.select(
        F.when(k % 211 == 0, F.lit("")).otherwise(
            F.concat_ws("-", k.cast("string"), F.col("l_linenumber").cast("string"))).alias("bill_id"),
        F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("meter_id"),
        F.when(k % 79 == 0, F.lit("2024-13")).otherwise(
            F.date_format("l_shipdate", "yyyy-MM")).alias("billing_month"),
        F.when(k % 97 == 0, F.lit("abc")).when(k % 101 == 0, F.lit("5d")).otherwise(
            _num_text(F.col("l_quantity"))).alias("consumption_kwh"),
        F.when(k % 73 == 0, F.lit("NA")).otherwise(
            _num_text(F.col("l_extendedprice"))).alias("energy_charges"),
        _num_text(F.col("l_discount") * 100).alias("meter_rent"),
        _num_text(F.col("l_extendedprice") * F.col("l_tax")).alias("gst"),
        F.when(k % 89 == 0, F.lit("")).when(k % 83 == 0, F.lit("NaN")).otherwise(
            _num_text(amount)).alias("total_amount"),
        F.when(F.col("l_returnflag") == "N", "Paid").when(F.col("l_returnflag") == "A", "Unpaid")
        .otherwise("Late").alias("status"),
        "division",
        "subdivision",
        source_file.alias("source_file"),
        F.struct(source_file.alias("source_file"), *numbers).alias("_ord"),
    )


def bills_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bills_text(bills_rows(spark, sf_dir))


def readings_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.col("event_id")
    volts = (F.lit(170) + F.get_json_object("props", "$.k").cast("int")).cast("double")
    kwh = F.col("value") - 5
    division = F.concat(F.lit("DIV"), F.lpad((F.col("user_id") % 5).cast("string"), 2, "0"))
    subdivision = F.concat(F.lit("SUB"), F.lpad((F.col("user_id") % 25).cast("string"), 2, "0"))
    source_file = F.concat_ws("/", division, subdivision, F.lit("readings"), F.lit("readings.csv"))
    return ev.select(
        F.when(k % 97 == 0, F.lit("x")).when(k % 101 == 0, F.lit("2024")).otherwise(
            F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.lpad(F.col("user_id").cast("string"), 12, "0").alias("meter_id"),
        F.when(k % 89 == 0, F.lit("NaN")).otherwise(
            _num_text(F.col("value") + 1000)).alias("reading"),
        F.when(k % 83 == 0, F.lit("abc")).otherwise(_num_text(kwh)).alias("consumption_kwh"),
        _num_text(volts).alias("voltage"),
        _num_text(F.when(volts > 0, kwh / (volts / 1000)).otherwise(F.lit(0.0))).alias("current_amp"),
        F.when(F.col("event_type") == "error", "ISSUE").otherwise("OK").alias("quality_flag"),
        division.alias("division"),
        subdivision.alias("subdivision"),
        source_file.alias("source_file"),
        F.struct(source_file.alias("source_file"), "event_id").alias("_ord"),
    )
