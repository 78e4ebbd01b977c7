"""Billing and reading-level operators: usage roll-ups, charges, tariffs,
customers, running register and anomaly flags.

Per-meter sequence operators (running register, gaps) never put a whole
meter into one window partition: the time line of a meter is cut into day
chunks, a per-chunk summary is prefix-summed over the chunks (a few hundred
rows per meter), and the row-level window runs inside (meter, day).  A meter
holding a third of all readings therefore spreads over as many tasks as it
has days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import billing as fb
from meterlake.operators.joins import maybe_broadcast, split_join

CHUNK = "day"


def usage_rollup(readings: DataFrame, unit: str = "month") -> DataFrame:
    """kWh and reading count per (meter, period); partial aggregation."""
    period = F.date_trunc(unit, "timestamp")
    return readings.where(F.col("meter_id").isNotNull()).groupBy("meter_id", period.alias("period")).agg(
        F.sum("consumption_kwh").alias("kwh"), F.count(F.lit(1)).alias("n_readings"))


def with_tariff(df: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Attach tariff columns by code (the tariff table is tiny and checked)."""
    return df.join(maybe_broadcast(tariffs, 10_000), "tariff_code", "inner")


def bill_charges(usage: DataFrame, meters: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Simplified monthly bill per (meter, month): energy at the flat rate,
    the tariff's meter rent, GST on both."""
    j = with_tariff(split_join(usage, meters.select("meter_id", "tariff_code"), "meter_id"), tariffs)
    ch = fb.flat_charges("kwh", "meter_rent", "gst_rate")
    return j.select(
        fb.bill_id("meter_id", F.month("period")).alias("bill_id"), "meter_id",
        F.date_format("period", "yyyy-MM").alias("billing_month"), "tariff_code",
        fb.tariff_class("name").alias("tariff_class"),
        F.round("kwh", 3).alias("consumption_kwh"), ch["energy_charges"].alias("energy_charges"),
        F.col("meter_rent"), ch["gst"].alias("gst"), ch["total_amount"].alias("total_amount"))


def slab_charges(usage: DataFrame, meters: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Energy charge from the tariff's progressive slabs."""
    j = with_tariff(split_join(usage, meters.select("meter_id", "tariff_code"), "meter_id"), tariffs)
    return j.select("meter_id", F.date_format("period", "yyyy-MM").alias("billing_month"),
                    "tariff_code", F.round("kwh", 3).alias("consumption_kwh"),
                    fb.slab_charge("kwh", "rates").alias("slab_energy"))


def peak_season_usage(readings: DataFrame) -> DataFrame:
    """kWh by season x time band."""
    return readings.where(F.col("timestamp").isNotNull()).groupBy(
        fb.season("timestamp").alias("season"), fb.time_band("timestamp").alias("band")).agg(
        F.count(F.lit(1)).alias("n_readings"), F.sum("consumption_kwh").alias("kwh"))


def customer_bills(bills: DataFrame, customers: DataFrame) -> DataFrame:
    """Bills with their customer (one customer per meter).  A meter with very many
    bills is split over several tasks."""
    return split_join(bills, customers, "meter_id")


def unprocessed(candidates: DataFrame, done: DataFrame, key: str = "meter_id") -> DataFrame:
    """Rows of ``candidates`` whose key has no row in ``done``."""
    return candidates.join(done.select(key).distinct(), key, "left_anti")


def running_total(df: DataFrame, key: str, ts: str, value: str, out: str,
                  chunk: str = CHUNK) -> DataFrame:
    """Cumulative sum of ``value`` per ``key`` in ``ts`` order (ts unique per
    key), computed in two levels (see module doc)."""
    c = F.date_trunc(chunk, ts)
    sums = df.groupBy(key, c.alias("_chunk")).agg(F.sum(value).alias("_s"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(key, "_chunk", F.coalesce(F.sum("_s").over(before), F.lit(0.0)).alias("_off"))
    upto = Window.partitionBy(key, "_chunk").orderBy(ts).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.withColumn("_chunk", c).withColumn("_in", F.sum(value).over(upto))
    j = inner.join(offsets, [key, "_chunk"], "inner")
    return j.withColumn(out, F.col("_off") + F.col("_in")).drop("_chunk", "_in", "_off")


def reading_anomalies(readings: DataFrame, spike: float = 5.0, cadence_hours: float = 1.0,
                      only_flagged: bool = True) -> DataFrame:
    """Flag gaps (more than ``cadence_hours`` since the meter's previous
    reading), zero consumption and spikes (>= ``spike`` x the meter's mean)."""
    src = readings.where(F.col("meter_id").isNotNull() & F.col("timestamp").isNotNull())
    c = F.date_trunc(CHUNK, "timestamp")
    # one row per meter and day: the day before's last reading and the meter's mean
    every, upto = Window.partitionBy("meter_id"), Window.partitionBy("meter_id").orderBy("_chunk")
    days = (src.groupBy("meter_id", c.alias("_chunk"))
            .agg(F.max("timestamp").alias("_last"), F.sum("consumption_kwh").alias("_s"),
                 F.count("consumption_kwh").alias("_n"))
            .select("meter_id", "_chunk", F.lag("_last").over(upto).alias("_before"),
                    F.sum("_s").over(every).alias("_s"), F.sum("_n").over(every).alias("_n"))
            .withColumn("_mean", F.when(F.col("_n") > 0, F.col("_s") / F.col("_n"))).drop("_s", "_n"))
    within = Window.partitionBy("meter_id", "_chunk").orderBy("timestamp")
    j = (src.withColumn("_chunk", c).withColumn("_in", F.lag("timestamp").over(within))
         .join(days, ["meter_id", "_chunk"], "inner").withColumn("_prev", F.coalesce("_in", "_before")))
    gap_h = (F.unix_micros("timestamp") - F.unix_micros("_prev")) / 3.6e9
    out = j.select(
        "meter_id", "timestamp", "consumption_kwh", F.round(gap_h, 4).alias("gap_hours"),
        F.coalesce(gap_h > cadence_hours, F.lit(False)).alias("is_gap"),
        F.coalesce(F.col("consumption_kwh") == 0, F.lit(False)).alias("is_zero"),
        F.coalesce((F.col("_mean") > 0) & (F.col("consumption_kwh") >= spike * F.col("_mean")),
                   F.lit(False)).alias("is_spike"))
    if only_flagged:
        out = out.where(F.col("is_gap") | F.col("is_zero") | F.col("is_spike"))
    return out
