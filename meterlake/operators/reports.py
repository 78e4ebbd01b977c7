"""Explorer reports over silver bills / readings.

Every report is exact over all rows (the original explorer sampled 10 % for
voltage); each is one scan with a partial + final hash aggregate.  Shares of a
total are computed on the *aggregated* frame (a handful of rows), never with a
window over raw rows.  NULL group keys are dropped, as in the original
``groupby``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.operators.distincts import with_distincts

# Month labels of the monthly trend.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

TOTAL_LABEL = "TOTAL"


def _r(c: Column, digits: int = 2) -> Column:
    return F.round(c, digits)


def _sum0(c: str) -> Column:
    """Sum where an empty or all-NULL group is 0 (not NULL), as in pandas."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def overview(df: DataFrame, approx: bool = False) -> DataFrame:
    """Rows and distinct divisions / subdivisions / meters (one row)."""
    columns = {"division": "n_divisions", "subdivision": "n_subdivisions", "meter_id": "n_meters"}
    if approx:
        return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.approx_count_distinct(c).alias(n) for c, n in columns.items()])
    one = with_distincts(df, list(columns), {"n_rows": ("sum", F.lit(1))})
    return one.select(F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
                      *[F.col(f"n_distinct_{c}").alias(n) for c, n in columns.items()])


def top_consumers(bills: DataFrame, n: int = 10) -> DataFrame:
    """The n meters with the largest total consumption, ranked 1..n.
    Ties are broken by meter_id so the result is deterministic."""
    totals = (bills.where(F.col("meter_id").isNotNull())
              .groupBy("meter_id").agg(_sum0("consumption_kwh").alias("total_kwh")))
    top = totals.orderBy(F.col("total_kwh").desc(), F.col("meter_id")).limit(n)
    # n rows only: a global window here is over the top-n, not the data.
    rank = F.row_number().over(Window.orderBy(F.col("total_kwh").desc(), F.col("meter_id")))
    return top.select(rank.cast("long").alias("rank"), "meter_id",
                      _r(F.col("total_kwh")).alias("total_kwh"))


def share_with_total(df: DataFrame, group: str, value_col: str, out: str,
                     within: list[str] | None = None) -> DataFrame:
    """sum(value) per group, its percent of the total, plus a TOTAL row
    (per ``within`` partition when given).  Ordered by the sum, descending."""
    within = within or []
    keys = within + [group]
    base = df.where(F.col(group).isNotNull())
    for w in within:
        base = base.where(F.col(w).isNotNull())
    sums = base.groupBy(*keys).agg(_sum0(value_col).alias(out))
    total = F.sum(out).over(Window.partitionBy(*within))
    res = _with_totals(sums.withColumn("_total", total), group, {out: "_total"}, within).select(
        *within, group, _r(F.col(out)).alias(out), _r(F.col(out) / F.col("_total") * 100, 4).alias("pct"), "is_total")
    return res.orderBy(*within, "is_total", F.col(out).desc(), group).drop("is_total")


def _with_totals(sums: DataFrame, group: str, totals: dict[str, str], within: list[str]) -> DataFrame:
    """``sums`` (one row per group, with the totals beside) and one TOTAL row per
    ``within`` partition, marked ``is_total``.  The raw rows are aggregated once;
    a TOTAL row comes out of its partition's first group."""
    first = F.row_number().over(Window.partitionBy(*within).orderBy(group)) == 1
    own = F.struct(F.col(group).alias(group), *[F.col(c).alias(c) for c in totals], F.lit(False).alias("is_total"))
    summed = F.struct(F.lit(TOTAL_LABEL).alias(group), *[F.col(t).alias(c) for c, t in totals.items()],
                      F.lit(True).alias("is_total"))
    return (sums.withColumn("_first", first)
            .withColumn("_row", F.explode(F.when(F.col("_first"), F.array(own, summed)).otherwise(F.array(own))))
            .select(*within, *totals.values(), "_row.*"))


def revenue_by_division(bills: DataFrame) -> DataFrame:
    return share_with_total(bills, "division", "total_amount", "revenue")


def consumption_by_subdivision(bills: DataFrame, division: str | None = None) -> DataFrame:
    """kWh per subdivision with percent of the division total and a TOTAL
    row.  With ``division`` given (trimmed, upper-cased) only that division
    is reported; without, every division is reported side by side."""
    if division is not None:
        one = bills.where(F.col("division") == F.upper(F.trim(F.lit(division))))
        return share_with_total(one, "subdivision", "consumption_kwh", "consumption_kwh")
    return share_with_total(bills, "subdivision", "consumption_kwh", "consumption_kwh",
                            within=["division"])


def payment_status(bills: DataFrame) -> DataFrame:
    """Bills (non-null bill_id) and amount per status, both as percent, and a
    TOTAL row."""
    base = bills.where(F.col("status").isNotNull())
    sums = base.groupBy("status").agg(F.count("bill_id").alias("bills"), _sum0("total_amount").alias("amount"))
    w = Window.partitionBy()                     # over the few statuses
    sums = sums.withColumns({"_bills": F.sum("bills").over(w), "_amount": F.sum("amount").over(w)})
    return _with_totals(sums, "status", {"bills": "_bills", "amount": "_amount"}, []).select(
        "status", F.col("bills").cast("long").alias("bills"), _r(F.col("amount")).alias("amount"),
        _r(F.col("bills") / F.col("_bills") * 100, 4).alias("bills_pct"),
        _r(F.col("amount") / F.col("_amount") * 100, 4).alias("amount_pct"), "is_total",
    ).orderBy("is_total", F.col("bills").desc(), "status").drop("is_total")


def voltage_band(v: str | Column = "voltage") -> Column:
    v = F.col(v) if isinstance(v, str) else v
    return (F.when(v < 200, "low").when(v <= 240, "normal").when(v > 240, "high"))


def voltage_quality(readings: DataFrame, fraction: float | None = None,
                    seed: int = 42) -> DataFrame:
    """Mean / sample std / min / max voltage and the low (<200), normal
    (200-240) and high (>240) bands with counts and percents.  Exact over all
    rows unless a sampling ``fraction`` is asked for."""
    src = readings.sample(fraction=fraction, seed=seed) if fraction else readings
    v = F.col("voltage")
    agg = src.agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean_v"), F.stddev_samp(v).alias("std_v"),
        F.min(v).alias("min_v"), F.max(v).alias("max_v"),
        F.count_if(v < 200).alias("n_low"),
        F.count_if((v >= 200) & (v <= 240)).alias("n_normal"),
        F.count_if(v > 240).alias("n_high"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    pct = lambda c: _r(F.col(c) / F.col("n_rows") * 100, 4)
    return agg.select(
        F.col("n").cast("long").alias("n"),
        _r(F.col("mean_v"), 4).alias("mean_v"), _r(F.col("std_v"), 4).alias("std_v"),
        "min_v", "max_v",
        *[F.col(c).cast("long").alias(c) for c in ("n_low", "n_normal", "n_high")],
        pct("n_low").alias("pct_low"), pct("n_normal").alias("pct_normal"),
        pct("n_high").alias("pct_high"),
    )


def month_label(m: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in MONTH_NAMES]), m)


def monthly_trend(bills: DataFrame, year: int | None = 2024) -> DataFrame:
    """kWh, revenue and bill count per month of ``year`` (a range predicate
    on billing_month, so it reaches the Parquet scan).  ``year=None``
    reports every year."""
    src = bills.where(F.col("billing_month").isNotNull())
    if year is not None:
        src = src.where((F.col("billing_month") >= F.lit(f"{year}-01-01").cast("timestamp"))
                        & (F.col("billing_month") < F.lit(f"{year + 1}-01-01").cast("timestamp")))
    g = src.groupBy(F.year("billing_month").cast("long").alias("year"),
                    F.month("billing_month").cast("long").alias("month"))
    out = g.agg(_sum0("consumption_kwh").alias("consumption_kwh"),
                _sum0("total_amount").alias("revenue"),
                F.count("bill_id").alias("bills"))
    return out.select(
        "year", "month", month_label(F.col("month").cast("int")).alias("month_name"),
        _r(F.col("consumption_kwh")).alias("consumption_kwh"),
        _r(F.col("revenue")).alias("revenue"),
        F.col("bills").cast("long").alias("bills"),
    ).orderBy("year", "month")


def flag_distribution(readings: DataFrame) -> DataFrame:
    """Count and percent of all rows (NULL flags included in the total) per
    quality flag."""
    counts = readings.groupBy("quality_flag").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    out = counts.select("quality_flag", "n", _r(F.col("n") / total * 100, 4).alias("pct"))
    return (out.where(F.col("quality_flag").isNotNull())
            .select("quality_flag", F.col("n").cast("long").alias("n"), "pct")
            .orderBy(F.col("n").desc(), "quality_flag"))


def table_statistics(df: DataFrame, name: str, time_col: str, approx: bool = False) -> DataFrame:
    """Rows, distinct meters / divisions / subdivisions and time range."""
    columns = {"meter_id": "n_meters", "division": "n_divisions", "subdivision": "n_subdivisions"}
    if approx:
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(time_col).alias("first"), F.max(time_col).alias("last"),
                     *[F.approx_count_distinct(c).alias(f"n_distinct_{c}") for c in columns])
    else:
        one = with_distincts(df, list(columns), {"n_rows": ("sum", F.lit(1)), "first": ("min", F.col(time_col)), "last": ("max", F.col(time_col))})
    return one.select(
        F.lit(name).alias("table_name"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        *[F.col(f"n_distinct_{c}").alias(n) for c, n in columns.items()],
        F.date_format("first", "yyyy-MM-dd HH:mm:ss").alias("min_time"), F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("max_time"))
