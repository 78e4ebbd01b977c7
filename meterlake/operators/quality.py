"""Data-quality profiling and validation.

All profiles are exact over all rows and computed in as few passes as
possible: one aggregate for every per-column count, the two-stage distincts of
:mod:`meterlake.operators.distincts`, the quantiles of :mod:`meterlake.operators.quantiles`.  Wide one-row
results are turned long with ``stack`` on the one-row frame, never on data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.distincts import long_counts, with_distincts
from meterlake.operators.joins import maybe_broadcast
from meterlake.operators.quantiles import quantile_table


def _r(c: Column, d: int = 4) -> Column:
    return F.round(c, d)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _unpivot(one_row: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """``one_row`` holds ``<stat>__<column>`` cells; return (column, stat...)."""
    parts = []
    for c in columns:
        parts.append(F.struct(F.lit(c).alias("column"),
                              *[F.col(f"{s}__{c}").alias(s) for s in stats]))
    return one_row.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*")


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first per key (NULL keys equal).  Two-stage count:
    partial counts per key before the shuffle, so a hot key costs one row per
    task."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    return per_key.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("long").alias("n_rows"),
                       F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL count and percent of rows (NaN counts as missing)."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)

    def missing(c: str) -> Column:
        cond = F.col(c).isNull()
        if types[c] in ("double", "float"):
            cond = cond | F.isnan(c)
        return cond

    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(missing(c)).alias(f"nulls__{c}") for c in columns])
    long = one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"nulls__{c}").alias("n_null")) for c in columns
    ])).alias("_s")).select("_n", "_s.*")
    return long.select("column", F.col("n_null").cast("long").alias("n_null"),
                       _r(F.col("n_null") / F.col("_n") * 100).alias("pct_null"))


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggs = []
    for c in columns:
        x = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"count__{c}"), F.min(x).alias(f"min__{c}"),
                 F.max(x).alias(f"max__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"std__{c}")]
    return _unpivot(df.agg(*aggs), columns, ["count", "min", "max", "mean", "std"])


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """min, max, mean, median (exact unless ``approx``) and sample std per
    numeric column."""
    columns = list(columns or numeric_columns(df))
    m = _moments(df, columns)
    med = quantile_table(df, columns, [0.5], names=["median"], approx=approx)
    j = m.join(med, "column", "left")
    return j.select("column", "min", "max", _r(F.col("mean")).alias("mean"),
                    _r(F.col("median")).alias("median"), _r(F.col("std")).alias("std"))


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: Q1, Q3, fences Q1-1.5 IQR / Q3+1.5 IQR and the number of
    values outside them.  Quartiles are exact; the count is one more pass with
    the fences as literals."""
    columns = list(columns or numeric_columns(df))
    qs = quantile_table(df, columns, [0.25, 0.75], names=["q1", "q3"], approx=approx).collect()
    bounds = {r["column"]: (r["q1"], r["q3"]) for r in qs}
    aggs = []
    for c in columns:
        q1, q3 = bounds.get(c, (None, None))
        if q1 is None:
            aggs.append(F.lit(0).cast("long").alias(f"n__{c}"))
            continue
        iqr = q3 - q1
        lo, hi = q1 - 1.5 * iqr, q3 + 1.5 * iqr
        x = F.col(c).cast("double")
        aggs.append(F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"n__{c}"))
    counts = _unpivot(df.agg(*aggs), columns, ["n"])
    b = df.sparkSession.createDataFrame(
        [(c, *bounds[c]) for c in columns if c in bounds],
        "column string, q1 double, q3 double")
    j = counts.join(b, "column", "left")
    iqr = F.col("q3") - F.col("q1")
    return j.select("column", _r(F.col("q1")).alias("q1"), _r(F.col("q3")).alias("q3"),
                    _r(F.col("q1") - 1.5 * iqr).alias("lower"), _r(F.col("q3") + 1.5 * iqr).alias("upper"),
                    F.col("n").cast("long").alias("n_outliers"))


# The rule checks of the quality report.
BILL_RULES = {
    "total_amount<=0": lambda: F.col("total_amount") <= 0,
    "consumption_kwh<0": lambda: F.col("consumption_kwh") < 0,
}
READING_RULES = {
    "voltage_outside_180_260": lambda: (F.col("voltage") < 180) | (F.col("voltage") > 260),
    "consumption_kwh<0": lambda: F.col("consumption_kwh") < 0,
}


def rule_violations(df: DataFrame, rules: dict, table: str) -> DataFrame:
    """One row per rule with the number of rows breaking it (one pass).
    ``rules`` maps a name to a Column or to a function returning one."""
    rules = {n: (r() if callable(r) else r) for n, r in rules.items()}
    names = list(rules)
    one = df.agg(*[F.count_if(rules[n]).alias(f"v{i}") for i, n in enumerate(names)])
    parts = [F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("rule"),
                      F.col(f"v{i}").cast("long").alias("violations")) for i, n in enumerate(names)]
    return one.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*")


def schema_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, non-null, null and distinct counts.  Exact ones come from
    one (column, value) count; ``approx`` keeps a sketch per column instead."""
    cols, types = df.columns, dict(df.dtypes)
    if approx:
        one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"nn__{c}") for c in cols],
                     *[F.approx_count_distinct(c).alias(f"u__{c}") for c in cols])
        parts = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                          F.col(f"nn__{c}").cast("long").alias("non_null"),
                          (F.col("_n") - F.col(f"nn__{c}")).cast("long").alias("nulls"),
                          F.col(f"u__{c}").cast("long").alias("n_unique")) for c in cols]
        return one.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*")
    per = long_counts(df, cols).groupBy("_i").agg(
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(0)).alias("non_null"),
        F.sum(F.when(F.col("_v").isNull(), F.col("_c")).otherwise(0)).alias("nulls"), F.count("_v").alias("n_unique"))
    names = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column"), F.lit(types[c]).alias("dtype")) for i, c in enumerate(cols)]))
    every = df.sparkSession.range(1).select(names.alias("_s")).select("_s.*")
    none = F.lit(0).cast("long")
    return every.join(per, F.col("i") == F.col("_i"), "left").select(
        "column", "dtype", *[F.coalesce(c, none).alias(c) for c in ("non_null", "nulls", "n_unique")])


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None,
                     approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles (exact unless ``approx``), max per
    numeric column."""
    columns = list(columns or numeric_columns(df))
    m = _moments(df, columns)
    q = quantile_table(df, columns, [0.25, 0.5, 0.75], names=["q25", "q50", "q75"], approx=approx)
    j = m.join(q, "column", "left")
    return j.select("column", F.col("count").cast("long").alias("count"),
                    _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"), "min",
                    _r(F.col("q25")).alias("q25"), _r(F.col("q50")).alias("q50"),
                    _r(F.col("q75")).alias("q75"), "max")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """``bins`` equal-width bins over [min, max] of the finite values; the maximum goes
    to the last bin.  Every bin is returned (count 0 when empty).  Infinite values have
    no place on that scale: if there are any, they are counted in bin -1 (below
    ``lower`` of the first) and bin ``bins`` (above ``upper`` of the last), so counts
    always sum to the number of non-null values."""
    x = F.col(column).cast("double")
    clean = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    finite = F.when(F.abs("x") != float("inf"), F.col("x"))
    mm = clean.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi"), F.count_if(F.col("x") == float("-inf")).alias("below"),
                   F.count_if(F.col("x") == float("inf")).alias("above")).collect()[0]
    lo, hi = mm["lo"], mm["hi"]
    spark = df.sparkSession
    ends = [(-1, float("-inf"), lo, mm["below"])] * (mm["below"] > 0) + [(bins, hi, float("inf"), mm["above"])] * (mm["above"] > 0)
    outer = spark.createDataFrame(ends, "bin int, lower double, upper double, n long")
    if lo is None:
        return outer
    # by halves: the span of two finite doubles may not be one
    step = (hi / 2 - lo / 2) / bins
    b = F.least(F.floor((F.col("x") / 2 - F.lit(lo / 2)) / F.lit(step)), F.lit(bins - 1)).cast("int") if step > 0 else F.lit(0)
    width = 2 * step
    counts = clean.where(F.abs("x") != float("inf")).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    j = all_bins.join(counts, "bin", "left")
    inner = j.select("bin", _r(F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                     _r(F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                     F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))
    return (inner.union(outer) if ends else inner).orderBy("bin")


def box_stats(df: DataFrame, column: str, by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """Five-number summary per group plus whiskers (most extreme values within
    1.5 IQR of the quartiles) and the number of points beyond them."""
    by = list(by)
    src = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    for k in by:
        src = src.where(F.col(k).isNotNull())
    q = quantile_table(src, [column], [0.25, 0.5, 0.75], by=by, names=["q1", "median", "q3"],
                       approx=approx)
    q = q.drop("column")
    x = F.col(column).cast("double")
    rows = src.select(*by, x.alias("x"))
    if by:
        # one row of quartiles per group: broadcast when proven small,
        # otherwise a shuffle join on the group key
        j = rows.join(maybe_broadcast(q), by, "inner")
    else:
        r = q.collect()[0]
        j = rows.select("x", *[F.lit(r[c]).alias(c) for c in ("q1", "median", "q3")])
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("x") >= F.col("q1") - 1.5 * iqr) & (F.col("x") <= F.col("q3") + 1.5 * iqr)
    g = j.groupBy(*by, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.min(F.when(inside, F.col("x"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("x"))).alias("upper_whisker"),
        F.count_if(~inside).alias("n_outliers"))
    return g.select(*by, F.col("n").cast("long").alias("n"), "min", _r(F.col("q1")).alias("q1"),
                    _r(F.col("median")).alias("median"), _r(F.col("q3")).alias("q3"), "max",
                    "lower_whisker", "upper_whisker", F.col("n_outliers").cast("long").alias("n_outliers"))


# Expected silver columns and the critical (must not be NULL)
# columns checked by the validator.
EXPECTED = {
    "bills": ["bill_id", "meter_id", "billing_month", "consumption_kwh", "energy_charges",
              "meter_rent", "gst", "total_amount", "status", "division", "subdivision",
              "source_file", "etl_timestamp"],
    "readings": ["timestamp", "meter_id", "reading", "consumption_kwh", "voltage", "current_amp",
                 "quality_flag", "division", "subdivision", "source_file", "etl_timestamp"],
}
CRITICAL = {
    "bills": ["bill_id", "meter_id", "consumption_kwh"],
    "readings": ["timestamp", "meter_id", "reading"],
}
KEYS = {"bills": ["bill_id"], "readings": ["timestamp", "meter_id"]}


def column_check(df: DataFrame, kind: str) -> list[str]:
    """Expected columns missing from ``df`` (schema only, no data read)."""
    return [c for c in EXPECTED[kind] if c not in df.columns]


def validate(df: DataFrame, kind: str) -> DataFrame:
    """Validation report (check, value, status) over all rows.

    Two passes: one two-stage aggregate for counts, nulls, rules, distincts, ranges
    and means; one two-stage count for duplicate keys."""
    spark = df.sparkSession
    missing = column_check(df, kind)
    rules = BILL_RULES if kind == "bills" else READING_RULES
    aggs: dict[str, tuple[str, Column, str]] = {"rows": ("sum", F.lit(1), "info")}
    for c in CRITICAL[kind]:
        if c in df.columns:
            aggs[f"nulls:{c}"] = ("sum", F.col(c).isNull().cast("int"), "zero")
    for name, cond in rules.items():
        aggs[f"rule:{name}"] = ("sum", F.coalesce(cond(), F.lit(False)).cast("int"), "zero")
    distincts = [c for c in ("meter_id", "division", "subdivision") if c in df.columns]
    time_col = "billing_month" if kind == "bills" else "timestamp"
    aggs["min:" + time_col] = ("min", F.unix_micros(time_col), "info")
    aggs["max:" + time_col] = ("max", F.unix_micros(time_col), "info")
    means = ["consumption_kwh", "total_amount"] if kind == "bills" else [
        "consumption_kwh", "voltage", "current_amp"]
    for c in means:
        aggs[f"sum:{c}"] = ("sum", F.col(c), "")
        aggs[f"count:{c}"] = ("sum", F.col(c).isNotNull().cast("int"), "")
    one = with_distincts(df, distincts, {n: (how, value) for n, (how, value, _) in aggs.items()})
    checks: list[tuple[str, Column, str]] = []
    for n, (how, _, status) in aggs.items():
        value = F.col(f"`{n}`")
        if how == "sum" and n.split(":")[0] in ("rows", "nulls", "rule"):
            checks.append((n, F.coalesce(value, F.lit(0)), status))
        elif how in ("min", "max"):
            checks.append((n, value / 1e6, status))
    checks[-2:-2] = [(f"distinct:{c}", F.col(f"n_distinct_{c}"), "info") for c in distincts]
    checks += [(f"mean:{c}", F.round(F.try_divide(F.col(f"`sum:{c}`"), F.col(f"`count:{c}`")), 4), "info") for c in means]
    parts = [F.struct(F.lit(n).alias("check"), value.cast("double").alias("value"),
                      (F.when(value == 0, "ok").otherwise("fail") if status == "zero" else F.lit("info")).alias("status"))
             for n, value, status in checks]
    body = one.select(F.explode(F.array(*parts)).alias("_s")).select("_s.*")
    dup = duplicate_count(df, KEYS[kind]).select(
        F.lit("duplicates:" + ",".join(KEYS[kind])).alias("check"),
        F.col("n_duplicates").cast("double").alias("value"),
        F.when(F.col("n_duplicates") == 0, "ok").otherwise("fail").alias("status"))
    cols = spark.createDataFrame(
        [("missing_columns", float(len(missing)), "ok" if not missing else "fail")],
        "check string, value double, status string")
    return cols.unionByName(body).unionByName(dup)


NUMERIC = {"bills": ["consumption_kwh", "energy_charges", "meter_rent", "gst", "total_amount"],
           "readings": ["reading", "consumption_kwh", "voltage", "current_amp"]}


def quality_report(df: DataFrame, kind: str) -> DataFrame:
    """The whole quality report of a table as (section, item, metric, value): rows and
    duplicates, NULLs, value ranges, outliers and broken rules.  Columns that the table
    lacks are left out."""
    def long(part: DataFrame, section: str, item: Column, metrics: Sequence[str]) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
        return part.select(F.lit(section).alias("section"), item.alias("item"), cells.alias("c")).select("section", "item", "c.metric", "c.value")

    columns = [c for c in EXPECTED[kind] if c in df.columns and c != "etl_timestamp"]
    numeric = [c for c in NUMERIC[kind] if c in columns]
    table, column = F.lit(",".join(KEYS[kind])), F.col("column")
    out = long(duplicate_count(df, KEYS[kind]), "duplicates", table, ["n_rows", "n_duplicates"])
    out = out.unionByName(long(null_profile(df, columns), "nulls", column, ["n_null", "pct_null"]))
    out = out.unionByName(long(value_ranges(df, numeric), "ranges", column, ["min", "max", "mean", "median", "std"]))
    out = out.unionByName(long(iqr_outliers(df, numeric), "outliers", column, ["lower", "upper", "n_outliers"]))
    rules = BILL_RULES if kind == "bills" else READING_RULES
    return out.unionByName(long(rule_violations(df, rules, kind), "rules", F.col("rule"), ["violations"]))
