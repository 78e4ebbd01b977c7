"""Exact distinct counts of several columns in two plain aggregations.

Several ``count(DISTINCT ...)`` in one aggregate are planned as an expansion of
every row, group key and aggregate per distinct column.  Here each row gives one
narrow (column, value) pair per column, equal pairs meet in the map tasks already,
and a second aggregation counts them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(df: DataFrame, column: str) -> Column:
    """The value as text that differs exactly where the values do."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (F.col(column) + F.lit(0.0).cast(kind)).cast("string")   # -0.0 equals 0.0
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(F.col(column).isNotNull(), F.to_json(F.struct(F.col(column).alias("v"))))
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    return F.col(column).cast("string")


def _pairs(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("i"), as_text(df, c).alias("v")) for i, c in enumerate(columns)]))


def long_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """_i (number of the column), _v (value as text, null for NULL), _c: its rows."""
    long = df.select(_pairs(df, columns).alias("_p")).select(F.col("_p.i").alias("_i"), F.col("_p.v").alias("_v"))
    return long.groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_c"))


def with_distincts(df: DataFrame, columns: Sequence[str], totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """One row: ``n_distinct_<column>`` of each column and the ``totals`` (name ->
    "sum", "min" or "max", and the value), from a single scan.  A total is taken from
    the pairs of the first column, of which every row has one."""
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    values = [value.alias(f"_t{k}") for k, (_, value) in enumerate(totals.values())]
    long = df.select(*values, _pairs(df, columns).alias("_p")).select(
        F.col("_p.i").alias("_i"), F.col("_p.v").alias("_v"), *[f"_t{k}" for k in range(len(totals))])
    per = long.groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_c"), *[
        fold[how](F.when(F.col("_i") == 0, F.col(f"_t{k}"))).alias(f"_t{k}") for k, (how, _) in enumerate(totals.values())])
    return per.agg(
        *[fold[how](f"_t{k}").alias(name) for k, (name, (how, _)) in enumerate(totals.items())],
        *[F.count_if((F.col("_i") == i) & F.col("_v").isNotNull()).alias(f"n_distinct_{c}") for i, c in enumerate(columns)])
