"""Column lists and schemas of the bronze text files and the silver tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names and order of the bronze files.
BILL_COLUMNS = [
    "bill_id", "meter_id", "billing_month", "consumption_kwh", "energy_charges",
    "meter_rent", "gst", "total_amount", "status",
]
READING_COLUMNS = [
    "timestamp", "meter_id", "reading", "consumption_kwh", "voltage",
    "current_amp", "quality_flag",
]
LINEAGE_COLUMNS = ["division", "subdivision", "source_file", "etl_timestamp"]

BILL_NUMERIC = ["consumption_kwh", "energy_charges", "meter_rent", "gst", "total_amount"]
READING_NUMERIC = ["reading", "consumption_kwh", "voltage", "current_amp"]

BILL_KEY = ["bill_id"]
READING_KEY = ["timestamp", "meter_id"]

# Where each kind of bronze file lives inside a subdivision folder.
KINDS = {
    "bills": {"folder": "bills", "file": "bills.tsv", "sep": "\t",
              "columns": BILL_COLUMNS, "key": BILL_KEY},
    "readings": {"folder": "readings", "file": "readings.csv", "sep": ",",
                 "columns": READING_COLUMNS, "key": READING_KEY},
}


def _silver(columns: list[str], temporal: dict[str, T.DataType], numeric: list[str]) -> T.StructType:
    fields = []
    for c in columns:
        if c in temporal:
            fields.append(T.StructField(c, temporal[c]))
        elif c in numeric:
            fields.append(T.StructField(c, T.DoubleType()))
        else:
            fields.append(T.StructField(c, T.StringType()))
    fields += [
        T.StructField("division", T.StringType()),
        T.StructField("subdivision", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("etl_timestamp", T.TimestampType()),
    ]
    return T.StructType(fields)


SILVER_BILLS = _silver(BILL_COLUMNS, {"billing_month": T.TimestampType()}, BILL_NUMERIC)
SILVER_READINGS = _silver(READING_COLUMNS, {"timestamp": T.TimestampType()}, READING_NUMERIC)
SILVER = {"bills": SILVER_BILLS, "readings": SILVER_READINGS}

# One row per (data_type, path, load): what was read, when, and how many rows
# of it survived cleaning.  Written only after the data commit.
MANIFEST = T.StructType([
    T.StructField("data_type", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("records", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
])

TARIFF = T.StructType([
    T.StructField("tariff_code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("rates", T.ArrayType(T.StructType([
        T.StructField("upper", T.DoubleType()),
        T.StructField("rate", T.DoubleType()),
    ]))),
    T.StructField("meter_rent", T.DoubleType()),
    T.StructField("service_rent", T.DoubleType()),
    T.StructField("gst_rate", T.DoubleType()),
])
