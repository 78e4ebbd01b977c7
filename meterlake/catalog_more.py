"""More registered queries: operators on data that can make them fail.

The cleaned stand-in tables never break a rule, cover one month of readings and give
files that are all covered.  These queries run the same operators over rows derived
from the same tables where that is not so.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import catalog as C
from meterlake import oracle as O
from meterlake.catalog import register
from meterlake.functions import billing as fb
from meterlake.operators import billing, clean, quality, reports
from meterlake.operators import logs as log_ops
from meterlake.operators.inventory import compression_ratio, coverage_summary, inventory_rollup, source_coverage
from meterlake.plans import staging, standins
from meterlake.sources import dimensions as dims
from meterlake.sources.inventory import file_inventory
from meterlake.sources.logs import parse_log
from meterlake.sources.silver import scan_silver

# ---------------------------------------------------------------- quality of uncleaned rows


def _validation_sql(kind: str, source: str, missing: str) -> str:
    key = "bill_id" if kind == "bills" else '"timestamp", meter_id'
    time = "billing_month" if kind == "bills" else '"timestamp"'
    nulls = ["bill_id", "meter_id", "consumption_kwh"] if kind == "bills" else ["timestamp", "meter_id", "reading"]
    rules = ([("total_amount<=0", "total_amount <= 0"), ("consumption_kwh<0", "consumption_kwh < 0")] if kind == "bills" else
             [("voltage_outside_180_260", "voltage < 180 OR voltage > 260"), ("consumption_kwh<0", "consumption_kwh < 0")])
    means = ["consumption_kwh", "total_amount"] if kind == "bills" else ["consumption_kwh", "voltage", "current_amp"]
    zero = [(f"nulls:{c}", f'count(*) FILTER (WHERE "{c}" IS NULL)') for c in nulls]
    zero += [(f"rule:{n}", f"count(*) FILTER (WHERE {cond})") for n, cond in rules]
    info = [("rows", "count(*)")] + [(f"distinct:{c}", f"count(DISTINCT {c})") for c in ("meter_id", "division", "subdivision") if c != missing]
    info += [(f"{f}:{time.strip(chr(34))}", f"epoch_us({f}({time})) / 1e6") for f in ("min", "max")]
    info += [(f"mean:{c}", f"round(avg({c}), 4)") for c in means]
    parts = [f"SELECT '{n}' AS \"check\", CAST({e} AS DOUBLE) AS value, CASE WHEN {e} = 0 THEN 'ok' ELSE 'fail' END AS status FROM {source}" for n, e in zero]
    parts += [f"SELECT '{n}', CAST({e} AS DOUBLE), 'info' FROM {source}" for n, e in info]
    parts.append("SELECT 'missing_columns', CAST(1 AS DOUBLE), 'fail'")
    dups = f"(SELECT CAST(sum(c - 1) AS DOUBLE) AS d FROM (SELECT count(*) AS c FROM {source} GROUP BY {key}))"
    parts.append(f"SELECT 'duplicates:{key.replace(chr(34), '').replace(' ', '')}', d, CASE WHEN d = 0 THEN 'ok' ELSE 'fail' END FROM {dups}")
    return "\nUNION ALL\n".join(parts)


@register("validate_uncleaned_bills", O.with_("bills_typed") + _validation_sql("bills", "bills_typed", "subdivision"))
def q_validate_uncleaned_bills(spark, sf_dir):
    """Rows before the filters, without one expected column: every check has something to find."""
    typed = C._typed_bills(spark, sf_dir).withColumn("etl_timestamp", C.run_ts())
    return quality.validate(typed.drop("subdivision"), "bills")


@register("validate_uncleaned_readings", O.with_("readings_typed") + _validation_sql("readings", "readings_typed", "division"))
def q_validate_uncleaned_readings(spark, sf_dir):
    typed = C._typed_readings(spark, sf_dir).withColumn("etl_timestamp", C.run_ts())
    return quality.validate(typed.drop("division"), "readings")


@register("missing_columns", """
SELECT unnest(['gst', 'status', 'source_file']) AS "column", (SELECT count(*) FROM lineitem) AS n_rows""")
def q_missing_columns(spark, sf_dir):
    """Expected less actual columns of a table that lacks three of them."""
    typed = C._typed_bills(spark, sf_dir).withColumn("etl_timestamp", C.run_ts()).drop("gst", "status", "source_file")
    absent = quality.column_check(typed, "bills")
    return typed.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(F.array(*[F.lit(c) for c in absent])).alias("column"), "n_rows")


@register("rule_violations_signed", O.with_("bills_typed") + """
SELECT 'bills' AS table_name, 'consumption_kwh<0' AS rule, CAST(count(*) FILTER (WHERE consumption_kwh - 25 < 0) AS BIGINT) AS violations FROM bills_typed
UNION ALL SELECT 'bills', 'total_amount<=0', CAST(count(*) FILTER (WHERE total_amount <= 0) AS BIGINT) FROM bills_typed""")
def q_rule_violations_signed(spark, sf_dir):
    """Consumption as the difference to 25 kWh, so that about half of it is negative."""
    typed = C._typed_bills(spark, sf_dir).withColumn("consumption_kwh", F.col("consumption_kwh") - 25)
    return quality.rule_violations(typed, quality.BILL_RULES, "bills")


def _report_sql() -> str:
    def cells(section: str, item: str, metrics: list[str], source: str) -> str:
        return "\nUNION ALL\n".join(
            f"SELECT '{section}' AS section, {item} AS item, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM ({source})" for m in metrics)
    read = O.with_("readings_typed")
    dups = ('SELECT sum(c) AS n_rows, sum(c - 1) AS n_duplicates FROM (SELECT count(*) AS c FROM readings_typed GROUP BY "timestamp", meter_id)')
    rules = ("SELECT 'voltage_outside_180_260' AS rule, count(*) FILTER (WHERE voltage < 180 OR voltage > 260) AS violations FROM readings_typed "
             "UNION ALL SELECT 'consumption_kwh<0', count(*) FILTER (WHERE consumption_kwh < 0) FROM readings_typed")
    return read + "\nUNION ALL\n".join([
        cells("duplicates", "'timestamp,meter_id'", ["n_rows", "n_duplicates"], dups),
        cells("nulls", '"column"', ["n_null", "pct_null"], C._null_sql("readings", C._READ_ALL, "readings_typed")),
        cells("ranges", '"column"', ["min", "max", "mean", "median", "std"], C._ranges_sql(C._READ_NUM, "readings_typed")),
        cells("outliers", '"column"', ["lower", "upper", "n_outliers"], C._iqr_sql(C._READ_NUM, "readings_typed")),
        cells("rules", "rule", ["violations"], rules)])


@register("quality_report", _report_sql())
def q_quality_report(spark, sf_dir):
    return quality.quality_report(C._typed_readings(spark, sf_dir), "readings")


# ---------------------------------------------------------------- filters, bands, charges

@register("consumption_one_division",
          O.with_("bills") + ", one AS (SELECT * FROM bills WHERE division = 'ASIA')" + C._share_sql("one", "subdivision", "consumption_kwh", "consumption_kwh"))
def q_consumption_one_division(spark, sf_dir):
    """The division argument is trimmed and put in capitals."""
    return reports.consumption_by_subdivision(C.silver_bills(spark, sf_dir), "  asia ")


@register("monthly_trend_year", O.with_("bills") + """
SELECT CAST(year(billing_month) AS BIGINT) AS year, CAST(month(billing_month) AS BIGINT) AS month,
       strftime(billing_month, '%b') AS month_name,
       round(coalesce(sum(consumption_kwh), 0), 2) AS consumption_kwh,
       round(coalesce(sum(total_amount), 0), 2) AS revenue, CAST(count(bill_id) AS BIGINT) AS bills
FROM bills WHERE year(billing_month) = 1997
GROUP BY year(billing_month), month(billing_month), strftime(billing_month, '%b')""")
def q_monthly_trend_year(spark, sf_dir):
    return reports.monthly_trend(C.silver_bills(spark, sf_dir), year=1997)


def _year_of_readings(spark, sf_dir):
    """The readings, each moved by event_id days and hours, so that they fill a year."""
    moved = F.col("timestamp") + F.make_dt_interval((F.col("id") % 366).cast("int"), (F.col("id") % 24).cast("int"))
    typed = C._typed_readings(spark, sf_dir).withColumn("id", F.col("_ord.event_id"))
    return typed.where(F.col("timestamp").isNotNull()).withColumn("timestamp", moved)


_YEAR_SQL = """
, year AS (SELECT "timestamp" + to_days(CAST(event_id % 366 AS INTEGER)) + to_hours(CAST(event_id % 24 AS INTEGER)) AS t, meter_id, consumption_kwh
           FROM readings_typed WHERE "timestamp" IS NOT NULL)"""


@register("peak_season_year", O.with_("readings_typed") + _YEAR_SQL + """
SELECT CASE WHEN month(t) IN (6, 7, 8) THEN 'summer' WHEN month(t) IN (12, 1, 2) THEN 'winter' ELSE 'other' END AS season,
       CASE WHEN hour(t) BETWEEN 7 AND 10 OR hour(t) BETWEEN 18 AND 23 THEN 'peak' WHEN hour(t) BETWEEN 0 AND 5 THEN 'night' ELSE 'offpeak' END AS band,
       count(*) AS n_readings, round(sum(consumption_kwh), 2) AS kwh
FROM year GROUP BY 1, 2""")
def q_peak_season_year(spark, sf_dir):
    found = billing.peak_season_usage(_year_of_readings(spark, sf_dir))
    return found.select("season", "band", "n_readings", F.round("kwh", 2).alias("kwh"))


@register("usage_rollup_year", O.with_("readings_typed") + _YEAR_SQL + f"""
SELECT meter_id, {O.ts_text("date_trunc('month', t)")} AS period, round(sum(consumption_kwh), 2) AS kwh, count(*) AS n_readings
FROM year WHERE meter_id IS NOT NULL GROUP BY meter_id, date_trunc('month', t)""")
def q_usage_rollup_year(spark, sf_dir):
    found = billing.usage_rollup(_year_of_readings(spark, sf_dir))
    return found.select("meter_id", C._ts("period"), F.round("kwh", 2).alias("kwh"), "n_readings")


@register("derive_current_signs", """
SELECT event_id, round(CASE WHEN v > 0 THEN value / (v / 1000) ELSE 0 END, 6) AS current_amp, v <= 0 AS no_voltage
FROM (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) - 50 AS v FROM events)""")
def q_derive_current_signs(spark, sf_dir):
    """Voltages around zero: half of them have no current."""
    ev = standins.table(spark, sf_dir, "events").select(
        "event_id", F.col("value").alias("consumption_kwh"), (F.get_json_object("props", "$.k").cast("double") - 50).alias("voltage"))
    return ev.select("event_id", F.round(fb.derive_current("consumption_kwh", "voltage"), 6).alias("current_amp"), (F.col("voltage") <= 0).alias("no_voltage"))


@register("slab_charges_low", O.with_("meters", "slabs") + """
, u AS (SELECT lpad(CAST(user_id AS VARCHAR), 12, '0') AS meter_id, event_id, CAST(event_id % 900 AS DOUBLE) AS kwh FROM events),
  j AS (SELECT u.*, m.tariff_code FROM u JOIN meters m USING (meter_id))
SELECT event_id, j.tariff_code, round(sum(rate * greatest(0, least(kwh, upper_kwh) - lower_kwh)), 2) AS slab_energy
FROM j JOIN slabs USING (tariff_code) GROUP BY event_id, j.tariff_code""")
def q_slab_charges_low(spark, sf_dir):
    """Usage from 0 to 899 kWh: every slab and each of its limits."""
    ev = standins.table(spark, sf_dir, "events").select(
        F.lpad(F.col("user_id").cast("string"), 12, "0").alias("meter_id"), "event_id", (F.col("event_id") % 900).cast("double").alias("kwh"))
    meters = dims.meters_from_customers(spark, sf_dir).select("meter_id", "tariff_code")
    j = billing.with_tariff(ev.join(meters, "meter_id"), dims.tariffs(spark))
    return j.select("event_id", "tariff_code", F.round(fb.slab_charge("kwh", "rates"), 2).alias("slab_energy"))


@register("customers_dimension", O.with_("customers") + """
SELECT customer_id, meter_id, name, 'Parent of ' || name AS father_name, 'House ' || CAST(k % 1000 AS VARCHAR) || ', ' || seg AS address,
       '000-' || lpad(CAST(k AS VARCHAR), 7, '0') AS phone, '00000-' || lpad(CAST(k AS VARCHAR), 7, '0') || '-' || CAST(k % 10 AS VARCHAR) AS cnic, payment_behavior
FROM customers JOIN (SELECT printf('%012d', c_custkey) AS meter_id, c_custkey AS k, c_mktsegment AS seg FROM customer) USING (meter_id)""")
def q_customers_dimension(spark, sf_dir):
    """Written and read again as a stored dimension, all columns."""
    path = C.scratch_path(spark, "customers")
    dims.customers_from_table(spark, sf_dir).write.parquet(path)
    return dims.read_dimension(spark, path, dims.CUSTOMER_COLUMNS)


@register("latest_readings", O.with_("readings_typed") + f"""
SELECT meter_id, {O.ts_text('"timestamp"')} AS "timestamp", event_id, reading FROM (
  SELECT *, row_number() OVER (PARTITION BY meter_id ORDER BY "timestamp" DESC NULLS LAST, event_id DESC) AS rn FROM readings_typed) WHERE rn = 1""")
def q_latest_readings(spark, sf_dir):
    """Keep-last: the newest reading of every meter; hours hold several, so ties occur."""
    typed = C._typed_readings(spark, sf_dir).select("meter_id", "timestamp", F.col("_ord.event_id").alias("event_id"), "reading")
    return clean.dedup_last(typed, ["meter_id"], ["timestamp", "event_id"]).select("meter_id", C._ts("timestamp"), "event_id", "reading")


# ---------------------------------------------------------------- files and logs

_FILES = """
WITH files AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'bills' ELSE 'readings' END AS data_type, o_orderpriority AS division,
                      CAST(o_custkey % 40 AS VARCHAR) AS subdivision, o_orderkey * 4099 AS length FROM orders)"""


def _given_files(spark, sf_dir):
    """An inventory with lengths of its own: one file per order."""
    key = F.col("o_orderkey")
    return standins.table(spark, sf_dir, "orders").select(
        F.when(key % 3 == 0, "bills").otherwise("readings").alias("data_type"), F.col("o_orderpriority").alias("division"),
        (F.col("o_custkey") % 40).cast("string").alias("subdivision"), (key * 4099).alias("length"))


@register("inventory_rollup_given", _FILES + """
SELECT data_type, division, count(*) AS n_files, count(DISTINCT subdivision) AS n_subdivisions, round(sum(length / 1048576), 3) AS total_mb,
       round(avg(length / 1048576), 3) AS avg_mb, round(min(length / 1048576), 3) AS min_mb, round(max(length / 1048576), 3) AS max_mb
FROM files GROUP BY data_type, division""")
def q_inventory_rollup_given(spark, sf_dir):
    return inventory_rollup(_given_files(spark, sf_dir))


@register("compression_ratio_given", _FILES + """
SELECT data_type, CAST(sum(length) AS BIGINT) AS source_bytes, CAST(sum(length // 5) AS BIGINT) AS silver_bytes,
       round((1 - CAST(sum(length // 5) AS DOUBLE) / CAST(sum(length) AS DOUBLE)) * 100, 2) AS space_saved_pct
FROM files GROUP BY data_type""")
def q_compression_ratio_given(spark, sf_dir):
    """A silver layout with a fifth of each file's bytes."""
    files = _given_files(spark, sf_dir)
    layout = {k: files.where(F.col("data_type") == k).select(F.floor(F.col("length") / 5).alias("bytes")) for k in ("bills", "readings")}
    return compression_ratio(files, layout)


@register("source_coverage_partial", O.with_("readings_typed") + """
SELECT 'readings' AS data_type, broken, NOT broken AS covered, count(DISTINCT subdivision) AS n_folders
FROM (SELECT division = 'DIV03' AS broken, subdivision FROM readings_typed) GROUP BY broken""")
def q_source_coverage_partial(spark, sf_dir):
    """Files of a tree whose one division could not be loaded: not all are covered."""
    tree, target = staging.staged_rejects(spark, sf_dir)
    found = source_coverage(file_inventory(spark, tree, ["readings"], "hive"), {"readings": scan_silver(spark, target, "readings")})
    folder = found.groupBy("data_type", "division", "subdivision").agg(F.bool_or("covered").alias("covered"))
    return folder.groupBy("data_type", (F.col("division") == staging.BROKEN_DIVISION).alias("broken"), "covered").agg(F.count(F.lit(1)).alias("n_folders"))


@register("coverage_summary_given", """
WITH files AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'bills' ELSE 'readings' END AS data_type, o_orderstatus = 'F' AS covered FROM orders)
SELECT data_type, count(*) AS n_files, count(*) FILTER (WHERE covered) AS n_covered,
       round(CAST(count(*) FILTER (WHERE covered) AS DOUBLE) / count(*) * 100, 2) AS pct_covered FROM files GROUP BY data_type""")
def q_coverage_summary_given(spark, sf_dir):
    files = standins.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, "bills").otherwise("readings").alias("data_type"), (F.col("o_orderstatus") == "F").alias("covered"))
    return coverage_summary(files)


@register("log_levels_in_messages", """
WITH lines AS (SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'click' THEN 'DEBUG' ELSE 'INFO' END AS level,
                      CASE event_id % 5 WHEN 0 THEN 'after ERROR' WHEN 1 THEN 'no INFO, one WARNING' WHEN 2 THEN 'errors' ELSE 'done' END AS message,
                      event_id % 7 = 0 AS odd FROM events)
SELECT l AS level, count(*) FILTER (WHERE contains(level || ' - ' || message, l)) AS n_containing, count(*) FILTER (WHERE NOT odd AND level = l) AS n_parsed
FROM lines, (SELECT unnest(['INFO', 'WARNING', 'ERROR', 'DEBUG']) AS l) GROUP BY l""")
def q_log_levels_in_messages(spark, sf_dir):
    """Messages that name levels, and lines out of format: both counts differ."""
    ev, level = standins.table(spark, sf_dir, "events"), F.lit("INFO")
    for kind, name in staging.EVENT_LEVEL.items():
        level = F.when(F.col("event_type") == kind, name).otherwise(level)
    n = F.col("event_id") % 5
    message = F.when(n == 0, "after ERROR").when(n == 1, "no INFO, one WARNING").when(n == 2, "errors").otherwise("done")
    stamp = F.when(F.col("event_id") % 7 == 0, "somewhen").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return log_ops.log_level_counts(parse_log(ev.select(F.concat_ws(" - ", stamp, level, message).alias("line"))))
