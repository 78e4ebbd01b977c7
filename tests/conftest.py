import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterlake.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="meterlake-tests")
    shared_dir(s)
    yield s


BILL_HEADER = ["bill_id", "meter_id", "billing_month", "consumption_kwh", "energy_charges",
               "meter_rent", "gst", "total_amount", "status"]
READING_HEADER = ["timestamp", "meter_id", "reading", "consumption_kwh", "voltage", "current_amp",
                  "quality_flag"]


def write_file(root, division, subdivision, kind, header, rows, sep=None):
    """Write one bronze file of the tree layout (plain Python, tiny)."""
    sep = sep or ("\t" if kind == "bills" else ",")
    name = "bills.tsv" if kind == "bills" else "readings.csv"
    d = root / division / subdivision / kind
    d.mkdir(parents=True, exist_ok=True)
    p = d / name
    with open(p, "w", encoding="utf-8") as fh:
        fh.write(sep.join(header) + "\n")
        for r in rows:
            fh.write(sep.join(r) + "\n")
    return p


def bill(bill_id, kwh="100", amount="50.5", month="2024-01", meter="000000000001", status="Paid"):
    return [bill_id, meter, month, kwh, "10.0", "18.06", "2.0", amount, status]


def reading(ts, meter="000000000001", reading_v="1000.5", kwh="1.5", volts="230", amp="6.5", flag="OK"):
    return [ts, meter, reading_v, kwh, volts, amp, flag]
