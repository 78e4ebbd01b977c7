"""Cleaning: coercion, keep-first de-duplication, validity filters.

Order matters and follows the files' original semantics: coerce, then
de-duplicate on the key, then filter.  A first copy that is invalid therefore
suppresses a later valid copy of the same key.

Keep-first is a ``row_number() == 1`` window, keep-last an aggregation.  Catalyst
plans the window with a *partial* ``WindowGroupLimit`` before the shuffle, so in both
each map task sends at most one row per key: a key that holds a third of all rows
costs one row per task in the exchange, not a third of the data in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.coerce import na_to_null, parse_month, parse_timestamp, to_double
from meterlake.schemas import (
    BILL_COLUMNS, BILL_KEY, BILL_NUMERIC, READING_COLUMNS, READING_KEY, READING_NUMERIC,
)

ORDER_COL = "_ord"   # struct giving the original (file) order of a bronze row
_RN = "_rn"


def _order_cols(order: Sequence[str | Column] | None) -> list[Column]:
    order = order or [ORDER_COL]
    return [F.col(o) if isinstance(o, str) else o for o in order]


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep the first row per key in ``order`` (default: bronze file order).
    NULL keys compare equal, as in the files' producers."""
    w = Window.partitionBy(*keys).orderBy(*[o.asc_nulls_first() for o in _order_cols(order)])
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row per key in ``order`` (newest wins; NULLs in it come first).
    A plain aggregation: map tasks keep one row per key already, and nothing is sorted
    by the order.  Rows equal in ``order`` are told apart by their other columns, so the
    result does not depend on how the rows arrive.  NULL keys compare equal."""
    rest = [c for c in df.columns if c not in keys]
    decide = F.struct(*order, *[c for c in rest if c not in order])
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), decide).alias("_last"))
    return last.select(*[F.col(c) if c in keys else F.col("_last")[c].alias(c) for c in df.columns])


def coerce_bills(df: DataFrame) -> DataFrame:
    """Bronze bill text -> typed columns (bad values become NULL)."""
    exprs = {}
    for c in BILL_COLUMNS:
        if c == "billing_month":
            exprs[c] = parse_month(c)
        elif c in BILL_NUMERIC:
            exprs[c] = to_double(c)
        else:
            exprs[c] = na_to_null(c)
    return df.withColumns(exprs)


def coerce_readings(df: DataFrame) -> DataFrame:
    exprs = {}
    for c in READING_COLUMNS:
        if c == "timestamp":
            exprs[c] = parse_timestamp(c)
        elif c in READING_NUMERIC:
            exprs[c] = to_double(c)
        else:
            exprs[c] = na_to_null(c)
    return df.withColumns(exprs)


def bill_is_valid() -> Column:
    return F.col("consumption_kwh").isNotNull() & (F.col("total_amount") > 0)


def reading_is_valid(v_min: float = 180.0, v_max: float = 260.0) -> Column:
    return (F.col("timestamp").isNotNull() & F.col("reading").isNotNull()
            & F.col("voltage").between(v_min, v_max) & (F.col("consumption_kwh") >= 0))


def _finish(df: DataFrame, columns: list[str], etl_ts: Column | None) -> DataFrame:
    out = df.withColumn("etl_timestamp", etl_ts if etl_ts is not None else F.current_timestamp())
    return out.select(*columns, "division", "subdivision", "source_file", "etl_timestamp")


def clean_bills(bronze: DataFrame, etl_ts: Column | None = None) -> DataFrame:
    """Bronze bills (text + lineage + ``_ord``) -> silver bills."""
    typed = coerce_bills(bronze)
    kept = dedup_first(typed, BILL_KEY).where(bill_is_valid())
    return _finish(kept, BILL_COLUMNS, etl_ts)


def clean_readings(bronze: DataFrame, etl_ts: Column | None = None,
                   v_min: float = 180.0, v_max: float = 260.0) -> DataFrame:
    """Bronze readings -> silver readings.  The key uses the *parsed*
    timestamp, so rows whose timestamp fails to parse share one NULL key."""
    typed = coerce_readings(bronze)
    kept = dedup_first(typed, READING_KEY).where(reading_is_valid(v_min, v_max))
    return _finish(kept, READING_COLUMNS, etl_ts)
