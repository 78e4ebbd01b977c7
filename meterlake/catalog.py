"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the shared test tables (whole
tables, no row subsets) and returns a DataFrame.  ``ORACLE`` holds the
matching DuckDB SQL where the result is expressible in SQL.  Computed columns
carry the same names on both sides; timestamps are rendered as text and float
sums rounded so both engines print the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import oracle as O
from meterlake.functions import billing as fb
from meterlake.operators import billing, clean, quality, reports
from meterlake.operators import logs as log_ops
from meterlake.operators.inventory import (
    compression_ratio, inventory_rollup, layout_report, source_coverage,
)
from meterlake.operators.setops import distinct_values, sample_rows, union_by_name
from meterlake.plans import staging, standins, store
from meterlake.plans.load import changed_files, frozen_inventory
from meterlake.plans.stats import load_statistics
from meterlake.schemas import SILVER_BILLS
from meterlake.session import scratch_path, sized
from meterlake.sources import dimensions as dims
from meterlake.sources import logs as log_src
from meterlake.sources.bronze import read_bronze
from meterlake.sources.inventory import file_inventory, path_lineage
from meterlake.sources.silver import preview, scan_silver, scan_tolerant
from meterlake.streaming.ingest import stream_ingest

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# A fixed run timestamp keeps registered results reproducible.
RUN_TS_TEXT = "2025-01-01 00:00:00"


def run_ts():
    return F.lit(RUN_TS_TEXT).cast("timestamp")


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # all timestamps of the tables are zone-less; reports are in UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def silver_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_bills(standins.bills_bronze(spark, sf_dir), etl_ts=run_ts())


def silver_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_readings(standins.readings_bronze(spark, sf_dir), etl_ts=run_ts())


def _ts(c: str, fmt: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(c, fmt).alias(c)


def _bill_text_cols(df: DataFrame) -> DataFrame:
    return df.select("bill_id", "meter_id", _ts("billing_month"), "consumption_kwh",
                     "energy_charges", "meter_rent", "gst", "total_amount", "status",
                     "division", "subdivision", "source_file")


def _reading_text_cols(df: DataFrame) -> DataFrame:
    return df.select(_ts("timestamp"), "meter_id", "reading", "consumption_kwh", "voltage",
                     "current_amp", "quality_flag", "division", "subdivision", "source_file")


_BILL_SQL_COLS = ("bill_id, meter_id, " + O.ts_text("billing_month") + " AS billing_month, "
                  "consumption_kwh, energy_charges, meter_rent, gst, total_amount, status, "
                  "division, subdivision, source_file")
_READING_SQL_COLS = (O.ts_text('"timestamp"') + ' AS "timestamp", meter_id, reading, '
                     "consumption_kwh, voltage, current_amp, quality_flag, division, "
                     "subdivision, source_file")


# ---------------------------------------------------------------- cleaning

@register("clean_bills", O.with_("bills") + f"SELECT {_BILL_SQL_COLS} FROM bills")
def q_clean_bills(spark, sf_dir):
    return _bill_text_cols(silver_bills(spark, sf_dir))


@register("clean_readings", O.with_("readings") + f"SELECT {_READING_SQL_COLS} FROM readings")
def q_clean_readings(spark, sf_dir):
    return _reading_text_cols(silver_readings(spark, sf_dir))


@register("coerce_numeric", O.with_("bills_typed") + """
SELECT bill_id, consumption_kwh, energy_charges, meter_rent, gst, total_amount,
       source_file FROM bills_typed""")
def q_coerce_numeric(spark, sf_dir):
    typed = clean.coerce_bills(standins.bills_bronze(spark, sf_dir))
    return typed.select("bill_id", "consumption_kwh", "energy_charges", "meter_rent", "gst",
                        "total_amount", "source_file")


@register("parse_month", O.with_("bills_typed") + f"""
SELECT bill_id, {O.ts_text('billing_month')} AS billing_month,
       billing_month IS NULL AS month_is_null FROM bills_typed""")
def q_parse_month(spark, sf_dir):
    typed = clean.coerce_bills(standins.bills_bronze(spark, sf_dir))
    return typed.select("bill_id", _ts("billing_month"),
                        F.col("billing_month").isNull().alias("month_is_null"))


@register("parse_timestamp", O.with_("readings_typed") + f"""
SELECT event_id_text, {O.ts_text('"timestamp"')} AS "timestamp" FROM (
  SELECT CAST(event_id AS VARCHAR) AS event_id_text, "timestamp" FROM readings_typed)""")
def q_parse_timestamp(spark, sf_dir):
    bronze = standins.readings_bronze(spark, sf_dir)
    typed = clean.coerce_readings(bronze)
    return typed.select(F.col("_ord.event_id").cast("string").alias("event_id_text"),
                        _ts("timestamp"))


@register("dedup_bills", O.with_("bills_first") + """
SELECT bill_id, consumption_kwh, total_amount, source_file FROM bills_first""")
def q_dedup_bills(spark, sf_dir):
    typed = clean.coerce_bills(standins.bills_bronze(spark, sf_dir))
    return clean.dedup_first(typed, ["bill_id"]).select(
        "bill_id", "consumption_kwh", "total_amount", "source_file")


@register("dedup_readings", O.with_("readings_first") + f"""
SELECT {O.ts_text('"timestamp"')} AS "timestamp", meter_id, reading, consumption_kwh
FROM readings_first""")
def q_dedup_readings(spark, sf_dir):
    typed = clean.coerce_readings(standins.readings_bronze(spark, sf_dir))
    return clean.dedup_first(typed, ["timestamp", "meter_id"]).select(
        _ts("timestamp"), "meter_id", "reading", "consumption_kwh")


# ---------------------------------------------------------------- reports

def _share_sql(source: str, group: str, value: str, out: str, within: str | None = None) -> str:
    if within is None:
        return f"""
, agg AS (
  SELECT {group}, coalesce(sum({value}), 0) AS v, GROUPING({group}) AS g
  FROM {source} WHERE {group} IS NOT NULL GROUP BY ROLLUP({group}))
SELECT CASE WHEN g = 1 THEN 'TOTAL' ELSE {group} END AS {group},
       round(v, 2) AS {out},
       round(v / max(CASE WHEN g = 1 THEN v END) OVER () * 100, 4) AS pct
FROM agg"""
    return f"""
, agg AS (
  SELECT {within}, {group}, coalesce(sum({value}), 0) AS v, GROUPING({within}, {group}) AS g
  FROM {source} WHERE {group} IS NOT NULL AND {within} IS NOT NULL
  GROUP BY ROLLUP({within}, {group}))
SELECT {within}, CASE WHEN g = 1 THEN 'TOTAL' ELSE {group} END AS {group},
       round(v, 2) AS {out},
       round(v / max(CASE WHEN g = 1 THEN v END) OVER (PARTITION BY {within}) * 100, 4) AS pct
FROM agg WHERE g <= 1"""


@register("revenue_by_division",
          O.with_("bills") + _share_sql("bills", "division", "total_amount", "revenue"))
def q_revenue_by_division(spark, sf_dir):
    return reports.revenue_by_division(silver_bills(spark, sf_dir))


@register("consumption_by_subdivision",
          O.with_("bills") + _share_sql("bills", "subdivision", "consumption_kwh",
                                        "consumption_kwh", within="division"))
def q_consumption_by_subdivision(spark, sf_dir):
    return reports.consumption_by_subdivision(silver_bills(spark, sf_dir))


_OVERVIEW_SQL = """
SELECT count(*) AS n_rows, count(DISTINCT division) AS n_divisions,
       count(DISTINCT subdivision) AS n_subdivisions, count(DISTINCT meter_id) AS n_meters
FROM {t}"""


@register("overview_bills", O.with_("bills") + _OVERVIEW_SQL.format(t="bills"))
def q_overview_bills(spark, sf_dir):
    return reports.overview(silver_bills(spark, sf_dir))


@register("overview_readings", O.with_("readings") + _OVERVIEW_SQL.format(t="readings"))
def q_overview_readings(spark, sf_dir):
    return reports.overview(silver_readings(spark, sf_dir))


@register("top_consumers", O.with_("bills") + """
SELECT CAST(row_number() OVER (ORDER BY total_kwh DESC, meter_id) AS BIGINT) AS rank,
       meter_id, round(total_kwh, 2) AS total_kwh
FROM (SELECT meter_id, coalesce(sum(consumption_kwh), 0) AS total_kwh FROM bills
      WHERE meter_id IS NOT NULL GROUP BY meter_id)
ORDER BY total_kwh DESC, meter_id LIMIT 10""")
def q_top_consumers(spark, sf_dir):
    return reports.top_consumers(silver_bills(spark, sf_dir), 10)


@register("payment_status", O.with_("bills") + """
, agg AS (
  SELECT status, count(bill_id) AS bills, coalesce(sum(total_amount), 0) AS amount, GROUPING(status) AS g
  FROM bills WHERE status IS NOT NULL GROUP BY ROLLUP(status))
SELECT CASE WHEN g = 1 THEN 'TOTAL' ELSE status END AS status,
       CAST(bills AS BIGINT) AS bills, round(amount, 2) AS amount,
       round(bills / max(CASE WHEN g = 1 THEN bills END) OVER () * 100, 4) AS bills_pct,
       round(amount / max(CASE WHEN g = 1 THEN amount END) OVER () * 100, 4) AS amount_pct
FROM agg""")
def q_payment_status(spark, sf_dir):
    return reports.payment_status(silver_bills(spark, sf_dir))


@register("voltage_quality", O.with_("readings") + """
SELECT CAST(count(voltage) AS BIGINT) AS n, round(avg(voltage), 4) AS mean_v,
       round(stddev_samp(voltage), 4) AS std_v, min(voltage) AS min_v, max(voltage) AS max_v,
       CAST(count(*) FILTER (WHERE voltage < 200) AS BIGINT) AS n_low,
       CAST(count(*) FILTER (WHERE voltage >= 200 AND voltage <= 240) AS BIGINT) AS n_normal,
       CAST(count(*) FILTER (WHERE voltage > 240) AS BIGINT) AS n_high,
       round(count(*) FILTER (WHERE voltage < 200) / count(*) * 100, 4) AS pct_low,
       round(count(*) FILTER (WHERE voltage >= 200 AND voltage <= 240) / count(*) * 100, 4) AS pct_normal,
       round(count(*) FILTER (WHERE voltage > 240) / count(*) * 100, 4) AS pct_high
FROM readings""")
def q_voltage_quality(spark, sf_dir):
    return reports.voltage_quality(silver_readings(spark, sf_dir))


@register("monthly_trend", O.with_("bills") + """
SELECT CAST(year(billing_month) AS BIGINT) AS year, CAST(month(billing_month) AS BIGINT) AS month,
       strftime(billing_month, '%b') AS month_name,
       round(coalesce(sum(consumption_kwh), 0), 2) AS consumption_kwh,
       round(coalesce(sum(total_amount), 0), 2) AS revenue, CAST(count(bill_id) AS BIGINT) AS bills
FROM bills WHERE billing_month IS NOT NULL
GROUP BY year(billing_month), month(billing_month), strftime(billing_month, '%b')""")
def q_monthly_trend(spark, sf_dir):
    return reports.monthly_trend(silver_bills(spark, sf_dir), year=None)


@register("flag_distribution", O.with_("readings") + """
SELECT quality_flag, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / (SELECT count(*) FROM readings) * 100, 4) AS pct
FROM readings WHERE quality_flag IS NOT NULL GROUP BY quality_flag""")
def q_flag_distribution(spark, sf_dir):
    return reports.flag_distribution(silver_readings(spark, sf_dir))


@register("table_statistics", O.with_("bills", "readings") + f"""
SELECT 'bills' AS table_name, count(*) AS n_rows, count(DISTINCT meter_id) AS n_meters,
       count(DISTINCT division) AS n_divisions, count(DISTINCT subdivision) AS n_subdivisions,
       {O.ts_text('min(billing_month)')} AS min_time, {O.ts_text('max(billing_month)')} AS max_time
FROM bills
UNION ALL
SELECT 'readings', count(*), count(DISTINCT meter_id), count(DISTINCT division),
       count(DISTINCT subdivision), {O.ts_text('min("timestamp")')}, {O.ts_text('max("timestamp")')}
FROM readings""")
def q_table_statistics(spark, sf_dir):
    return reports.table_statistics(silver_bills(spark, sf_dir), "bills", "billing_month").unionByName(
        reports.table_statistics(silver_readings(spark, sf_dir), "readings", "timestamp"))


# ---------------------------------------------------------------- quality

def _typed_bills(spark, sf_dir):
    return clean.coerce_bills(standins.bills_bronze(spark, sf_dir))


def _typed_readings(spark, sf_dir):
    return clean.coerce_readings(standins.readings_bronze(spark, sf_dir))


_BILL_NUM = ["consumption_kwh", "energy_charges", "meter_rent", "gst", "total_amount"]
_READ_NUM = ["reading", "consumption_kwh", "voltage", "current_amp"]


def _sql_unpivot(cols, select_for_col, source):
    return "\nUNION ALL\n".join(select_for_col(c) + f" FROM {source}" for c in cols)


@register("duplicate_count", O.with_("bills_typed", "readings_typed") + """
SELECT 'bills' AS table_name, CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(c - 1) AS BIGINT) AS n_duplicates
FROM (SELECT bill_id, count(*) AS c FROM bills_typed GROUP BY bill_id)
UNION ALL
SELECT 'readings', CAST(sum(c) AS BIGINT), CAST(sum(c - 1) AS BIGINT)
FROM (SELECT "timestamp", meter_id, count(*) AS c FROM readings_typed GROUP BY "timestamp", meter_id)""")
def q_duplicate_count(spark, sf_dir):
    b = quality.duplicate_count(_typed_bills(spark, sf_dir), ["bill_id"])
    r = quality.duplicate_count(_typed_readings(spark, sf_dir), ["timestamp", "meter_id"])
    return (b.select(F.lit("bills").alias("table_name"), "*")
            .unionByName(r.select(F.lit("readings").alias("table_name"), "*")))


_BILL_ALL = ["bill_id", "meter_id", "billing_month", "consumption_kwh", "energy_charges",
             "meter_rent", "gst", "total_amount", "status", "division", "subdivision", "source_file"]
_READ_ALL = ["timestamp", "meter_id", "reading", "consumption_kwh", "voltage", "current_amp",
             "quality_flag", "division", "subdivision", "source_file"]


def _null_sql(table, cols, source):
    def one(c):
        q = f'"{c}"'
        return (f"SELECT '{table}' AS table_name, '{c}' AS \"column\", "
                f"CAST(count(*) FILTER (WHERE {q} IS NULL) AS BIGINT) AS n_null, "
                f"round(count(*) FILTER (WHERE {q} IS NULL) / count(*) * 100, 4) AS pct_null")
    return _sql_unpivot(cols, one, source)


@register("null_profile", O.with_("bills_typed", "readings_typed") + _null_sql(
    "bills", _BILL_ALL, "bills_typed") + "\nUNION ALL\n" + _null_sql("readings", _READ_ALL, "readings_typed"))
def q_null_profile(spark, sf_dir):
    b = quality.null_profile(_typed_bills(spark, sf_dir), _BILL_ALL)
    r = quality.null_profile(_typed_readings(spark, sf_dir), _READ_ALL)
    return (b.select(F.lit("bills").alias("table_name"), "*")
            .unionByName(r.select(F.lit("readings").alias("table_name"), "*")))


def _ranges_sql(cols, source):
    return _sql_unpivot(cols, lambda c: (
        f"SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max, round(avg({c}), 4) AS mean, "
        f"round(quantile_cont({c}, 0.5), 4) AS median, round(stddev_samp({c}), 4) AS std"), source)


@register("value_ranges", O.with_("bills") + _ranges_sql(_BILL_NUM, "bills"))
def q_value_ranges(spark, sf_dir):
    return quality.value_ranges(silver_bills(spark, sf_dir), _BILL_NUM)


def _iqr_sql(cols, source):
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3,
       round(q1 - 1.5 * (q3 - q1), 4) AS lower, round(q3 + 1.5 * (q3 - q1), 4) AS upper,
       CAST((SELECT count(*) FROM {source} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source})""")
    return "\nUNION ALL\n".join(parts)


@register("iqr_outliers", O.with_("readings") + _iqr_sql(_READ_NUM, "readings"))
def q_iqr_outliers(spark, sf_dir):
    return quality.iqr_outliers(silver_readings(spark, sf_dir), _READ_NUM)


@register("rule_violations", O.with_("bills_typed", "readings_typed") + """
SELECT 'bills' AS table_name, 'total_amount<=0' AS rule, CAST(count(*) FILTER (WHERE total_amount <= 0) AS BIGINT) AS violations FROM bills_typed
UNION ALL SELECT 'bills', 'consumption_kwh<0', CAST(count(*) FILTER (WHERE consumption_kwh < 0) AS BIGINT) FROM bills_typed
UNION ALL SELECT 'readings', 'voltage_outside_180_260', CAST(count(*) FILTER (WHERE voltage < 180 OR voltage > 260) AS BIGINT) FROM readings_typed
UNION ALL SELECT 'readings', 'consumption_kwh<0', CAST(count(*) FILTER (WHERE consumption_kwh < 0) AS BIGINT) FROM readings_typed""")
def q_rule_violations(spark, sf_dir):
    return quality.rule_violations(_typed_bills(spark, sf_dir), quality.BILL_RULES, "bills").unionByName(
        quality.rule_violations(_typed_readings(spark, sf_dir), quality.READING_RULES, "readings"))


_BILL_TYPES = {"billing_month": "timestamp", **{c: "double" for c in _BILL_NUM}}


def _schema_sql(cols, types, source):
    return _sql_unpivot(cols, lambda c: (
        f"SELECT '{c}' AS \"column\", '{types.get(c, 'string')}' AS dtype, "
        f"CAST(count({c}) AS BIGINT) AS non_null, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
        f"CAST(count(DISTINCT {c}) AS BIGINT) AS n_unique"), source)


@register("schema_profile", O.with_("bills") + _schema_sql(_BILL_ALL, _BILL_TYPES, "bills"))
def q_schema_profile(spark, sf_dir):
    return quality.schema_profile(silver_bills(spark, sf_dir).select(*_BILL_ALL))


def _describe_sql(cols, source):
    return _sql_unpivot(cols, lambda c: (
        f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, "
        f"round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75, "
        f"max({c}) AS max"), source)


@register("describe_numeric", O.with_("readings") + _describe_sql(_READ_NUM, "readings"))
def q_describe_numeric(spark, sf_dir):
    return quality.describe_numeric(silver_readings(spark, sf_dir), _READ_NUM)


@register("histogram", O.with_("bills") + """
, mm AS (SELECT min(total_amount) AS lo, max(total_amount) AS hi, (max(total_amount) - min(total_amount)) / 50 AS w FROM bills),
counts AS (
  SELECT CAST(least(floor((total_amount - lo) / w), 49) AS INTEGER) AS bin, count(*) AS n
  FROM bills, mm WHERE total_amount IS NOT NULL GROUP BY 1)
SELECT b.bin, round(lo + b.bin * w, 4) AS lower, round(lo + (b.bin + 1) * w, 4) AS upper,
       CAST(coalesce(n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(50)) b CROSS JOIN mm
LEFT JOIN counts c ON b.bin = c.bin""")
def q_histogram(spark, sf_dir):
    return quality.histogram(silver_bills(spark, sf_dir), "total_amount", 50)


@register("box_stats", O.with_("bills") + """
, q AS (SELECT division, quantile_cont(total_amount, 0.25) AS q1, quantile_cont(total_amount, 0.5) AS median,
               quantile_cont(total_amount, 0.75) AS q3 FROM bills WHERE division IS NOT NULL GROUP BY division)
SELECT b.division, CAST(count(*) AS BIGINT) AS n, min(total_amount) AS min, round(q.q1, 4) AS q1,
       round(q.median, 4) AS median, round(q.q3, 4) AS q3, max(total_amount) AS max,
       min(total_amount) FILTER (WHERE total_amount BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)) AS lower_whisker,
       max(total_amount) FILTER (WHERE total_amount BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)) AS upper_whisker,
       CAST(count(*) FILTER (WHERE NOT (total_amount BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1))) AS BIGINT) AS n_outliers
FROM bills b JOIN q ON b.division = q.division
GROUP BY b.division, q.q1, q.median, q.q3""")
def q_box_stats(spark, sf_dir):
    return quality.box_stats(silver_bills(spark, sf_dir), "total_amount", ["division"])


def _validate_sql(kind):
    if kind == "bills":
        src, crit, time_col = "bills", ["bill_id", "meter_id", "consumption_kwh"], "billing_month"
        rules = [("total_amount<=0", "total_amount <= 0"), ("consumption_kwh<0", "consumption_kwh < 0")]
        means = ["consumption_kwh", "total_amount"]
        dup = "SELECT bill_id, count(*) AS c FROM bills GROUP BY bill_id"
        dup_name = "bill_id"
    else:
        src, crit, time_col = "readings", ["\"timestamp\"", "meter_id", "reading"], '"timestamp"'
        rules = [("voltage_outside_180_260", "voltage < 180 OR voltage > 260"),
                 ("consumption_kwh<0", "consumption_kwh < 0")]
        means = ["consumption_kwh", "voltage", "current_amp"]
        dup = 'SELECT "timestamp", meter_id, count(*) AS c FROM readings GROUP BY "timestamp", meter_id'
        dup_name = "timestamp,meter_id"
    rows = ["SELECT 'missing_columns' AS \"check\", 0.0 AS value, 'ok' AS status",
            f"SELECT 'rows', CAST(count(*) AS DOUBLE), 'info' FROM {src}"]
    for c in crit:
        n = c.strip('"')
        rows.append(f"SELECT 'nulls:{n}', CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE), "
                    f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) = 0 THEN 'ok' ELSE 'fail' END FROM {src}")
    for n, cond in rules:
        rows.append(f"SELECT 'rule:{n}', CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE), "
                    f"CASE WHEN count(*) FILTER (WHERE {cond}) = 0 THEN 'ok' ELSE 'fail' END FROM {src}")
    for c in ("meter_id", "division", "subdivision"):
        rows.append(f"SELECT 'distinct:{c}', CAST(count(DISTINCT {c}) AS DOUBLE), 'info' FROM {src}")
    t = time_col.strip('"')
    rows.append(f"SELECT 'min:{t}', epoch_us(min({time_col})) / 1e6, 'info' FROM {src}")
    rows.append(f"SELECT 'max:{t}', epoch_us(max({time_col})) / 1e6, 'info' FROM {src}")
    for c in means:
        rows.append(f"SELECT 'mean:{c}', round(avg({c}), 4), 'info' FROM {src}")
    rows.append(f"SELECT 'duplicates:{dup_name}', CAST(coalesce(sum(c - 1), 0) AS DOUBLE), "
                f"CASE WHEN coalesce(sum(c - 1), 0) = 0 THEN 'ok' ELSE 'fail' END FROM ({dup})")
    return O.with_(src) + "\nUNION ALL\n".join(rows)


@register("validate_bills", _validate_sql("bills"))
def q_validate_bills(spark, sf_dir):
    return quality.validate(silver_bills(spark, sf_dir), "bills")


@register("validate_readings", _validate_sql("readings"))
def q_validate_readings(spark, sf_dir):
    return quality.validate(silver_readings(spark, sf_dir), "readings")


# ---------------------------------------------------------------- files: scans, loads, manifest

def _staged(spark, sf_dir, kinds=staging.BOTH):
    return staging.staged(spark, sf_dir, kinds)


def _tree(spark, sf_dir, kinds=staging.BOTH):
    return staging.staged_tree(spark, sf_dir, kinds)


def _source_dir(c: str = "source_file"):
    return F.regexp_replace(F.col(c), "/[^/]*$", "").alias("source_dir")


def _sql_source_dir(kind: str) -> str:
    return f"'{kind}/division=' || division || '/subdivision=' || subdivision AS source_dir"


def _scan_typed(spark, sf_dir, kind):
    inv = frozen_inventory(spark, _tree(spark, sf_dir, [kind]), [kind], "hive")
    raw = read_bronze(spark, inv, kind, "hive")
    return clean.coerce_bills(raw) if kind == "bills" else clean.coerce_readings(raw)


@register("scan_bills_tsv", O.with_("bills_typed") + f"""
SELECT bill_id, meter_id, {O.ts_text('billing_month')} AS billing_month, consumption_kwh,
       energy_charges, meter_rent, gst, total_amount, status, division, subdivision,
       {_sql_source_dir('bills')} FROM bills_typed""")
def q_scan_bills_tsv(spark, sf_dir):
    t = _scan_typed(spark, sf_dir, "bills")
    return t.select("bill_id", "meter_id", _ts("billing_month"), "consumption_kwh", "energy_charges",
                    "meter_rent", "gst", "total_amount", "status", "division", "subdivision",
                    _source_dir())


@register("scan_readings_csv", O.with_("readings_typed") + f"""
SELECT {O.ts_text('"timestamp"')} AS "timestamp", meter_id, reading, consumption_kwh, voltage,
       current_amp, quality_flag, division, subdivision, {_sql_source_dir('readings')}
FROM readings_typed""")
def q_scan_readings_csv(spark, sf_dir):
    t = _scan_typed(spark, sf_dir, "readings")
    return t.select(_ts("timestamp"), "meter_id", "reading", "consumption_kwh", "voltage",
                    "current_amp", "quality_flag", "division", "subdivision", _source_dir())


@register("lineage_columns", O.with_("bills_typed", "readings_typed") + f"""
SELECT 'bills' AS data_type, division, subdivision, {_sql_source_dir('bills')}, CAST(count(*) AS BIGINT) AS n_rows
FROM bills_typed GROUP BY division, subdivision
UNION ALL
SELECT 'readings', division, subdivision, {_sql_source_dir('readings')}, CAST(count(*) AS BIGINT)
FROM readings_typed GROUP BY division, subdivision""")
def q_lineage_columns(spark, sf_dir):
    out = None
    for kind in ("bills", "readings"):
        t = _scan_typed(spark, sf_dir, kind)
        g = t.groupBy("division", "subdivision", _source_dir()).agg(
            F.count(F.lit(1)).alias("n_rows")).select(F.lit(kind).alias("data_type"), "*")
        out = g if out is None else out.unionByName(g)
    return out


@register("file_inventory", O.with_("bills_typed", "readings_typed") + """
SELECT DISTINCT 'bills' AS data_type, division, subdivision, true AS has_bytes FROM bills_typed
UNION ALL
SELECT DISTINCT 'readings', division, subdivision, true FROM readings_typed""")
def q_file_inventory(spark, sf_dir):
    inv = file_inventory(spark, _tree(spark, sf_dir), layout="hive")
    return inv.groupBy("data_type", "division", "subdivision").agg(
        (F.sum("length") > 0).alias("has_bytes"))


@register("full_load_bills", O.with_("bills") + """
SELECT bill_id, meter_id, strftime(billing_month, '%Y-%m-%d %H:%M:%S') AS billing_month, consumption_kwh,
       energy_charges, meter_rent, gst, total_amount, status, division, subdivision FROM bills""")
def q_full_load_bills(spark, sf_dir):
    s = scan_silver(spark, _staged(spark, sf_dir, ["bills"]).silver, "bills")
    return s.select("bill_id", "meter_id", _ts("billing_month"), "consumption_kwh", "energy_charges",
                    "meter_rent", "gst", "total_amount", "status", "division", "subdivision")


@register("full_load_readings", O.with_("readings") + f"""
SELECT {O.ts_text('"timestamp"')} AS "timestamp", meter_id, reading, consumption_kwh, voltage,
       current_amp, quality_flag, division, subdivision FROM readings""")
def q_full_load_readings(spark, sf_dir):
    s = scan_silver(spark, _staged(spark, sf_dir, ["readings"]).silver, "readings")
    return s.select(_ts("timestamp"), "meter_id", "reading", "consumption_kwh", "voltage",
                    "current_amp", "quality_flag", "division", "subdivision")


@register("scan_silver", O.with_("bills") + """
SELECT division, CAST(count(*) AS BIGINT) AS n_rows, round(sum(total_amount), 2) AS revenue
FROM bills GROUP BY division""")
def q_scan_silver(spark, sf_dir):
    s = scan_silver(spark, _staged(spark, sf_dir, ["bills"]).silver, "bills")
    return s.groupBy("division").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.round(F.sum("total_amount"), 2).alias("revenue"))


@register("preview_rows", O.with_("bills") + """
SELECT bill_id, meter_id, consumption_kwh, total_amount FROM bills
WHERE bill_id IS NOT NULL ORDER BY bill_id LIMIT 10""")
def q_preview_rows(spark, sf_dir):
    s = scan_silver(spark, _staged(spark, sf_dir, ["bills"]).silver, "bills").where(F.col("bill_id").isNotNull())
    return preview(s.select("bill_id", "meter_id", "consumption_kwh", "total_amount"), 10, ["bill_id"])


@register("manifest_records", O.with_("bills", "readings", "bills_typed", "readings_typed") + """
, subs AS (SELECT DISTINCT 'bills' AS data_type, division, subdivision FROM bills_typed
           UNION ALL SELECT DISTINCT 'readings', division, subdivision FROM readings_typed),
  cnt AS (SELECT 'bills' AS data_type, division, subdivision, count(*) AS c FROM bills GROUP BY 2, 3
          UNION ALL SELECT 'readings', division, subdivision, count(*) FROM readings GROUP BY 2, 3)
SELECT s.data_type, s.division, s.subdivision, CAST(coalesce(c.c, 0) AS BIGINT) AS records
FROM subs s LEFT JOIN cnt c USING (data_type, division, subdivision)""")
def q_manifest_records(spark, sf_dir):
    m = store.committed_manifest(spark, _staged(spark, sf_dir).silver)
    lin = path_lineage(F.col("path"), "hive")
    return m.select("data_type", lin["division"].alias("division"),
                    lin["subdivision"].alias("subdivision"), "records").groupBy(
        "data_type", "division", "subdivision").agg(F.sum("records").cast("long").alias("records"))


def _merge_sql(kind: str, cols: str) -> str:
    typed = "bills_typed" if kind == "bills" else "readings_typed"
    key = ["bill_id"] if kind == "bills" else ['"timestamp"', "meter_id"]
    cond = " AND ".join(f"b2.{k} IS NOT DISTINCT FROM b1.{k}" for k in key)
    return (O.with_(typed) + "," + O.batch_ctes(kind) + f"""
SELECT {cols} FROM {kind}_b2
UNION ALL
SELECT {cols} FROM {kind}_b1 b1 WHERE NOT EXISTS (SELECT 1 FROM {kind}_b2 b2 WHERE {cond})""")


_MERGE_BILL_COLS = ("bill_id, meter_id, consumption_kwh, total_amount, status, division, "
                    "strftime(billing_month, '%Y-%m-%d %H:%M:%S') AS billing_month")
_MERGE_READ_COLS = ("strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\", meter_id, reading, "
                    "consumption_kwh, voltage, quality_flag")


@register("merge_bills", _merge_sql("bills", _MERGE_BILL_COLS))
def q_merge_bills(spark, sf_dir):
    s = scan_silver(spark, staging.merged(spark, sf_dir, "bills"), "bills")
    return s.select("bill_id", "meter_id", "consumption_kwh", "total_amount", "status", "division",
                    _ts("billing_month"))


@register("merge_readings", _merge_sql("readings", _MERGE_READ_COLS))
def q_merge_readings(spark, sf_dir):
    s = scan_silver(spark, staging.merged(spark, sf_dir, "readings"), "readings")
    return s.select(_ts("timestamp"), "meter_id", "reading", "consumption_kwh", "voltage", "quality_flag")


@register("append_load", O.with_("bills_typed") + "," + O.batch_ctes("bills") + f"""
SELECT {_MERGE_BILL_COLS} FROM bills_b1 UNION ALL SELECT {_MERGE_BILL_COLS} FROM bills_b2""")
def q_append_load(spark, sf_dir):
    s = scan_silver(spark, staging.appended(spark, sf_dir, "bills"), "bills")
    return s.select("bill_id", "meter_id", "consumption_kwh", "total_amount", "status", "division",
                    _ts("billing_month"))


@register("changed_files", O.with_("bills_typed", "readings_typed") + """
, batches AS (SELECT DISTINCT 'bills' AS data_type, division, subdivision, NOT (l_shipdate < TIMESTAMP '1998-01-01') AS late FROM bills_typed
              UNION ALL SELECT DISTINCT 'readings', division, subdivision, quality_flag <> 'OK' FROM readings_typed)
SELECT data_type, division, subdivision, bool_or(NOT late) AS known_files, bool_or(late) AS new_files
FROM batches GROUP BY data_type, division, subdivision""")
def q_changed_files(spark, sf_dir):
    """Per folder: whether files that were known stayed out, and whether new ones are
    picked (a folder may have either, both or, for the anti-join, files of both kinds)."""
    known = spark.read.parquet(*[staging.first_manifest(spark, sf_dir, k) for k in staging.BOTH])
    inv = union_by_name([file_inventory(spark, staging.arrivals(spark, sf_dir, k).tree, [k], "hive") for k in staging.BOTH])
    picked = changed_files(inv, known).select(F.col("path").alias("picked"))
    both = inv.join(picked, F.col("path") == F.col("picked"), "left")
    return both.groupBy("data_type", "division", "subdivision").agg(
        F.bool_or(F.col("picked").isNull()).alias("known_files"), F.bool_or(F.col("picked").isNotNull()).alias("new_files"))


@register("load_rejects", O.with_("readings", "readings_typed") + """
, subs AS (SELECT DISTINCT division, subdivision FROM readings_typed),
  cnt AS (SELECT division, subdivision, count(*) AS c FROM readings GROUP BY 1, 2)
SELECT s.division, s.subdivision, s.division = 'DIV03' AS rejected,
       CASE WHEN s.division = 'DIV03' THEN 'missing columns: voltage' END AS reason,
       CAST(CASE WHEN s.division = 'DIV03' THEN 0 ELSE coalesce(c.c, 0) END AS BIGINT) AS n_rows,
       s.division <> 'DIV03' AS in_manifest
FROM subs s LEFT JOIN cnt c USING (division, subdivision)""")
def q_load_rejects(spark, sf_dir):
    """Files without a needed column are reported, not loaded and not in the manifest;
    all others are loaded."""
    tree, target = staging.staged_rejects(spark, sf_dir)
    keys = ["division", "subdivision"]
    inv = file_inventory(spark, tree, ["readings"], "hive")
    bad = store.load_rejects(spark, target).select("path", "reason")
    known = store.committed_manifest(spark, target).select("path", F.lit(True).alias("known"))
    files = inv.join(bad, "path", "left").join(known, "path", "left").groupBy(*keys).agg(
        F.bool_or(F.col("reason").isNotNull()).alias("rejected"), F.max("reason").alias("reason"),
        F.bool_or(F.coalesce("known", F.lit(False))).alias("in_manifest"))
    rows = scan_silver(spark, target, "readings").groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return files.join(rows, keys, "left").select(*keys, "rejected", "reason", F.coalesce("c", F.lit(0)).cast("long").alias("n_rows"), "in_manifest")


@register("export_roundtrip", O.with_("bills_typed", "readings_typed") + """
SELECT 'bills' AS data_type, division, subdivision, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(bill_id) AS BIGINT) AS n_keys FROM bills_typed GROUP BY division, subdivision
UNION ALL
SELECT 'readings', division, subdivision, CAST(count(*) AS BIGINT), CAST(count("timestamp") AS BIGINT)
FROM readings_typed GROUP BY division, subdivision""")
def q_export_roundtrip(spark, sf_dir):
    out = None
    for kind, key in (("bills", "bill_id"), ("readings", "timestamp")):
        t = _scan_typed(spark, sf_dir, kind)
        g = t.groupBy("division", "subdivision").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count(key).alias("n_keys")).select(
            F.lit(kind).alias("data_type"), "*")
        out = g if out is None else out.unionByName(g)
    return out


@register("source_coverage", O.with_("bills", "readings", "bills_typed", "readings_typed") + """
, subs AS (SELECT DISTINCT 'bills' AS data_type, division, subdivision FROM bills_typed
           UNION ALL SELECT DISTINCT 'readings', division, subdivision FROM readings_typed),
  got AS (SELECT DISTINCT 'bills' AS data_type, division, subdivision FROM bills
          UNION ALL SELECT DISTINCT 'readings', division, subdivision FROM readings)
SELECT s.data_type, s.division, s.subdivision, g.division IS NOT NULL AS covered
FROM subs s LEFT JOIN got g USING (data_type, division, subdivision)""")
def q_source_coverage(spark, sf_dir):
    s = _staged(spark, sf_dir)
    inv = file_inventory(spark, s.tree, layout="hive")
    cov = source_coverage(inv, {k: scan_silver(spark, s.silver, k) for k in ("bills", "readings")})
    return cov.groupBy("data_type", "division", "subdivision").agg(
        F.max("covered").alias("covered"))


# ---------------------------------------------------------------- billing / readings re-aims

def _usage3(spark, sf_dir):
    u = billing.usage_rollup(silver_readings(spark, sf_dir), "month")
    return u.withColumn("kwh", F.round("kwh", 3))


@register("format_ids", """
SELECT o_orderkey, printf('%012d', o_custkey) AS meter_id, 'CUST' || printf('%08d', o_custkey) AS customer_id,
       'BILL' || printf('%012d', o_custkey) || printf('%02d', month(o_orderdate)) AS bill_id
FROM orders""")
def q_format_ids(spark, sf_dir):
    o = standins.table(spark, sf_dir, "orders")
    m = fb.meter_id("o_custkey")
    return o.select("o_orderkey", m.alias("meter_id"), fb.customer_id("o_custkey").alias("customer_id"),
                    fb.bill_id(m, F.month("o_orderdate")).alias("bill_id"))


@register("tariff_class", O.with_("meters", "tariffs") + """
SELECT m.tariff_code, t.name, CASE WHEN t.name LIKE '%Residential%' THEN 'Residential'
       WHEN t.name LIKE '%Commercial%' THEN 'Commercial' ELSE 'Industrial' END AS tariff_class,
       CAST(count(*) AS BIGINT) AS n_meters
FROM meters m JOIN tariffs t ON m.tariff_code = t.tariff_code GROUP BY 1, 2, 3""")
def q_tariff_class(spark, sf_dir):
    j = billing.with_tariff(dims.meters_from_customers(spark, sf_dir), dims.tariffs(spark))
    return j.groupBy("tariff_code", "name", fb.tariff_class("name").alias("tariff_class")).agg(
        F.count(F.lit(1)).alias("n_meters"))


@register("peak_season_usage", O.with_("readings") + """
SELECT CASE WHEN month("timestamp") IN (6, 7, 8) THEN 'summer' WHEN month("timestamp") IN (12, 1, 2) THEN 'winter'
            ELSE 'other' END AS season,
       CASE WHEN hour("timestamp") BETWEEN 7 AND 10 OR hour("timestamp") BETWEEN 18 AND 23 THEN 'peak'
            WHEN hour("timestamp") BETWEEN 0 AND 5 THEN 'night' ELSE 'offpeak' END AS band,
       CAST(count(*) AS BIGINT) AS n_readings, round(sum(consumption_kwh), 3) AS kwh
FROM readings GROUP BY 1, 2""")
def q_peak_season_usage(spark, sf_dir):
    u = billing.peak_season_usage(silver_readings(spark, sf_dir))
    return u.select("season", "band", F.col("n_readings").cast("long"), F.round("kwh", 3).alias("kwh"))


@register("usage_rollup", O.with_("usage") + """
SELECT meter_id, strftime(period, '%Y-%m') AS period, kwh, CAST(n_readings AS BIGINT) AS n_readings FROM usage""")
def q_usage_rollup(spark, sf_dir):
    u = _usage3(spark, sf_dir)
    return u.select("meter_id", F.date_format("period", "yyyy-MM").alias("period"), "kwh",
                    F.col("n_readings").cast("long"))


@register("bill_charges", O.with_("usage", "meters", "tariffs") + """
SELECT 'BILL' || u.meter_id || printf('%02d', month(u.period)) AS bill_id, u.meter_id,
       strftime(u.period, '%Y-%m') AS billing_month, m.tariff_code,
       CASE WHEN t.name LIKE '%Residential%' THEN 'Residential' WHEN t.name LIKE '%Commercial%' THEN 'Commercial'
            ELSE 'Industrial' END AS tariff_class,
       round(u.kwh, 3) AS consumption_kwh,
       CAST(round(e, 2) AS DOUBLE) AS energy_charges, t.meter_rent,
       CAST(round((e + CAST(t.meter_rent AS DECIMAL(18,2))) * CAST(t.gst_rate AS DECIMAL(10,4)), 2) AS DOUBLE) AS gst,
       CAST(round(e + CAST(t.meter_rent AS DECIMAL(18,2))
                  + (e + CAST(t.meter_rent AS DECIMAL(18,2))) * CAST(t.gst_rate AS DECIMAL(10,4)), 2) AS DOUBLE)
         AS total_amount
FROM (SELECT *, CAST(kwh AS DECIMAL(18,3)) * CAST(15.0 AS DECIMAL(10,4)) AS e FROM usage) u
JOIN meters m ON u.meter_id = m.meter_id JOIN tariffs t ON m.tariff_code = t.tariff_code""")
def q_bill_charges(spark, sf_dir):
    return billing.bill_charges(_usage3(spark, sf_dir), dims.meters_from_customers(spark, sf_dir),
                                dims.tariffs(spark))


@register("slab_charges", O.with_("usage", "meters", "slabs") + """
SELECT u.meter_id, strftime(u.period, '%Y-%m') AS billing_month, m.tariff_code, round(u.kwh, 3) AS consumption_kwh,
       CAST(round(sum(CAST(greatest(least(u.kwh, s.upper_kwh) - s.lower_kwh, 0) AS DECIMAL(18,3))
                      * CAST(s.rate AS DECIMAL(10,4))), 2) AS DOUBLE) AS slab_energy
FROM usage u JOIN meters m ON u.meter_id = m.meter_id JOIN slabs s ON m.tariff_code = s.tariff_code
GROUP BY u.meter_id, u.period, m.tariff_code, u.kwh""")
def q_slab_charges(spark, sf_dir):
    return billing.slab_charges(_usage3(spark, sf_dir), dims.meters_from_customers(spark, sf_dir),
                                dims.tariffs(spark))


@register("derive_current", O.with_("readings") + f"""
SELECT meter_id, {O.ts_text('"timestamp"')} AS "timestamp",
       round(CASE WHEN voltage > 0 THEN consumption_kwh / (voltage / 1000) ELSE 0 END, 4) AS current_amp
FROM readings""")
def q_derive_current(spark, sf_dir):
    r = silver_readings(spark, sf_dir)
    return r.select("meter_id", _ts("timestamp"),
                    F.round(fb.derive_current("consumption_kwh", "voltage"), 4).alias("current_amp"))


@register("register_running_total", O.with_("readings") + f"""
SELECT meter_id, {O.ts_text('"timestamp"')} AS "timestamp", consumption_kwh,
       round(sum(consumption_kwh) OVER (PARTITION BY meter_id ORDER BY "timestamp"
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3) AS register_kwh
FROM readings""")
def q_register_running_total(spark, sf_dir):
    r = silver_readings(spark, sf_dir).select("meter_id", "timestamp", "consumption_kwh")
    rt = billing.running_total(r, "meter_id", "timestamp", "consumption_kwh", "register_kwh")
    return rt.select("meter_id", _ts("timestamp"), "consumption_kwh",
                     F.round("register_kwh", 3).alias("register_kwh"))


@register("reading_anomalies", O.with_("readings") + f"""
SELECT meter_id, {O.ts_text('"timestamp"')} AS "timestamp", consumption_kwh, round(gap_h, 4) AS gap_hours,
       coalesce(gap_h > 1.0, false) AS is_gap, coalesce(consumption_kwh = 0, false) AS is_zero,
       coalesce(mean_kwh > 0 AND consumption_kwh >= 5.0 * mean_kwh, false) AS is_spike
FROM (SELECT *, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (PARTITION BY meter_id ORDER BY "timestamp"))) / 3.6e9 AS gap_h,
             avg(consumption_kwh) OVER (PARTITION BY meter_id) AS mean_kwh
      FROM readings WHERE meter_id IS NOT NULL)
WHERE coalesce(gap_h > 1.0, false) OR coalesce(consumption_kwh = 0, false)
   OR coalesce(mean_kwh > 0 AND consumption_kwh >= 5.0 * mean_kwh, false)""")
def q_reading_anomalies(spark, sf_dir):
    a = billing.reading_anomalies(silver_readings(spark, sf_dir), spike=5.0)
    return a.select("meter_id", _ts("timestamp"), "consumption_kwh", "gap_hours", "is_gap", "is_zero",
                    "is_spike")


@register("unprocessed_meters", O.with_("meters", "readings") + """
SELECT meter_id, division, tariff_code FROM meters m
WHERE NOT EXISTS (SELECT 1 FROM readings r WHERE r.meter_id = m.meter_id)""")
def q_unprocessed_meters(spark, sf_dir):
    m = dims.meters_from_customers(spark, sf_dir)
    return billing.unprocessed(m, silver_readings(spark, sf_dir)).select("meter_id", "division", "tariff_code")


@register("customer_bills", O.with_("bills", "customers") + """
SELECT b.bill_id, c.customer_id, c.name, c.payment_behavior, b.total_amount
FROM bills b JOIN customers c ON b.meter_id = c.meter_id""")
def q_customer_bills(spark, sf_dir):
    bills = silver_bills(spark, sf_dir).select("bill_id", "meter_id", "total_amount")
    with sized(spark, standins.table(spark, sf_dir, "lineitem").count()):
        j = billing.customer_bills(bills, dims.customers_from_table(spark, sf_dir))
    return j.select("bill_id", "customer_id", "name", "payment_behavior", "total_amount")


# ---------------------------------------------------------------- logs

def _parsed_log(spark, sf_dir):
    return log_src.parse_log(log_src.scan_log(spark, staging.staged_log(spark, sf_dir)))


@register("log_parse", O.with_("log") + """
SELECT ts_text AS ts, level, message FROM log""")
def q_log_parse(spark, sf_dir):
    p = _parsed_log(spark, sf_dir)
    return p.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "level", "message")


@register("log_level_counts", O.with_("log") + """
SELECT lv AS level,
       CAST((SELECT count(*) FROM log WHERE (ts_text || ' - ' || level || ' - ' || message) LIKE '%' || lv || '%') AS BIGINT) AS n_containing,
       CAST((SELECT count(*) FROM log WHERE level = lv) AS BIGINT) AS n_parsed
FROM (VALUES ('INFO'), ('WARNING'), ('ERROR'), ('DEBUG')) v(lv)""")
def q_log_level_counts(spark, sf_dir):
    return log_ops.log_level_counts(_parsed_log(spark, sf_dir))


@register("log_search", O.with_("log") + """
SELECT ts_text || ' - ' || level || ' - ' || message AS line FROM log
WHERE level IN ('ERROR', 'WARNING') AND lower(message) LIKE '%user=1%'
ORDER BY ts DESC, event_id DESC LIMIT 25""")
def q_log_search(spark, sf_dir):
    return log_ops.log_search(_parsed_log(spark, sf_dir), ["ERROR", "WARNING"], "USER=1", 25,
                           from_end=True).select("line")


# ---------------------------------------------------------------- set operations, sampling, layout

@register("union_tables", O.with_("bills", "readings") + """
SELECT division, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(bill_id) AS BIGINT) AS n_bills,
       CAST(count(reading) AS BIGINT) AS n_readings
FROM (SELECT division, bill_id, NULL AS reading FROM bills
      UNION ALL SELECT division, NULL, reading FROM readings) GROUP BY division""")
def q_union_tables(spark, sf_dir):
    u = union_by_name([silver_bills(spark, sf_dir), silver_readings(spark, sf_dir)])
    return u.groupBy("division").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.count("bill_id").alias("n_bills"),
                                     F.count("reading").alias("n_readings"))


@register("distinct_divisions", O.with_("bills", "readings") + """
SELECT DISTINCT division FROM (SELECT division FROM bills UNION ALL SELECT division FROM readings)""")
def q_distinct_divisions(spark, sf_dir):
    return distinct_values([silver_bills(spark, sf_dir), silver_readings(spark, sf_dir)], "division")


@register("sample_rows", O.with_("bills") + """
SELECT bill_id, meter_id, consumption_kwh, total_amount FROM bills
WHERE substr(md5(concat_ws(chr(31), '42', coalesce(bill_id, chr(0)))), 1, 13) < '1999999999999'""")
def q_sample_rows(spark, sf_dir):
    return sample_rows(silver_bills(spark, sf_dir), 0.1, ["bill_id"], seed=42).select(
        "bill_id", "meter_id", "consumption_kwh", "total_amount")


@register("layout_report")
def q_layout_report(spark, sf_dir):
    versions = store.latest_versions(spark, _staged(spark, sf_dir).silver)
    return layout_report(spark, [p for v in versions.values() for p in v.paths])


@register("inventory_rollup")
def q_inventory_rollup(spark, sf_dir):
    return inventory_rollup(file_inventory(spark, _tree(spark, sf_dir), layout="hive"))


@register("compression_ratio")
def q_compression_ratio(spark, sf_dir):
    s = _staged(spark, sf_dir)
    inv = file_inventory(spark, s.tree, layout="hive")
    versions = store.latest_versions(spark, s.silver)
    return compression_ratio(inv, {k: layout_report(spark, v.paths) for k, v in versions.items()})


@register("scan_tolerant", O.with_("bills") + """
SELECT lower(replace(division, ' ', '-')) AS folder, CAST(sum(CASE WHEN division IN ('ASIA', 'EUROPE') THEN 0 ELSE 1 END) AS BIGINT) AS n_rows,
       division IN ('ASIA', 'EUROPE') AS skipped FROM bills GROUP BY division
UNION ALL SELECT 'junk', 0, true UNION ALL SELECT 'none', 0, false""")
def q_scan_tolerant(spark, sf_dir):
    """Rows of the whole parts, and the folders with skipped ones: junk, and the
    divisions damaged in the middle; the empty part is whole."""
    path = staging.with_corrupt_part(spark, sf_dir)
    res = scan_tolerant(spark, path, SILVER_BILLS)
    folder = F.regexp_extract("path", "([^/]+)/[^/]+$", 1)
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
              .select(folder.alias("folder")).distinct())
    rows = res.data.groupBy(F.lower(F.replace("division", F.lit(" "), F.lit("-"))).alias("f")).agg(F.count(F.lit(1)).alias("n"))
    gone = res.skipped.select(folder.alias("g")).distinct()
    out = listed.join(rows, F.col("folder") == F.col("f"), "left").join(gone, F.col("folder") == F.col("g"), "left")
    return out.select("folder", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"), F.col("g").isNotNull().alias("skipped"))


# ---------------------------------------------------------------- streaming

_STREAMED: dict[tuple[str, str], str] = {}


@register("stream_ingest", O.with_("bills") + """
SELECT bill_id, meter_id, strftime(billing_month, '%Y-%m-%d %H:%M:%S') AS billing_month, consumption_kwh,
       energy_charges, meter_rent, gst, total_amount, status, division, subdivision FROM bills""")
def q_stream_ingest(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STREAMED:
        target = scratch_path(spark, "streamed")
        for q in stream_ingest(spark, _tree(spark, sf_dir, ["bills"]), target, target + "/_checkpoints", ["bills"],
                               layout="hive"):
            q.awaitTermination()
        _STREAMED[key] = target
    out = scan_silver(spark, _STREAMED[key], "bills")
    return out.select("bill_id", "meter_id", _ts("billing_month"), "consumption_kwh", "energy_charges",
                      "meter_rent", "gst", "total_amount", "status", "division", "subdivision")


@register("load_statistics")
def q_load_statistics(spark, sf_dir):
    return load_statistics(spark, _staged(spark, sf_dir).silver)


from meterlake import catalog_more  # noqa: E402,F401  (registers its queries here)
