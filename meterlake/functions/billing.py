"""Column expressions for identifiers, tariffs, bands and charges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def meter_id(n: str | Column) -> Column:
    """12-digit zero-padded meter number."""
    return F.format_string("%012d", _c(n).cast("long"))


def customer_id(n: str | Column) -> Column:
    return F.format_string("CUST%08d", _c(n).cast("long"))


def bill_id(meter: str | Column, month: str | Column) -> Column:
    """``BILL<meter><mm>``."""
    return F.format_string("BILL%s%02d", _c(meter), _c(month).cast("int"))


def tariff_class(name: str | Column) -> Column:
    """Residential / Commercial / Industrial from a tariff name; the first
    match wins, so 'Residential Commercial' is Residential."""
    n = _c(name)
    return (F.when(n.contains("Residential"), "Residential")
            .when(n.contains("Commercial"), "Commercial").otherwise("Industrial"))


def time_band(ts: str | Column) -> Column:
    """peak 07-10 and 18-23 h, night 00-05 h, offpeak otherwise."""
    h = F.hour(_c(ts))
    return (F.when(h.between(7, 10) | h.between(18, 23), "peak")
            .when(h.between(0, 5), "night").otherwise("offpeak"))


def season(ts: str | Column) -> Column:
    """summer Jun-Aug, winter Dec-Feb, other months otherwise."""
    m = F.month(_c(ts))
    return (F.when(m.isin(6, 7, 8), "summer").when(m.isin(12, 1, 2), "winter").otherwise("other"))


def derive_current(kwh: str | Column, volts: str | Column) -> Column:
    """Current (A) from consumption (kWh) and voltage (V); 0 when V <= 0."""
    v = _c(volts)
    return F.when(v > 0, _c(kwh) / (v / 1000)).otherwise(F.lit(0.0))


# The flat energy rate (per kWh) of the simplified bill.
FLAT_RATE = 15.0

# Money is computed in decimal: kWh to 0.001, rents to 0.01, rates to 0.0001.
# Exact products and sums, then HALF_UP to cents, so a charge that lands on a
# half cent is rounded the same on every engine.
KWH = "decimal(18,3)"
MONEY = "decimal(18,2)"
RATE = "decimal(10,4)"


def _cents(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def flat_charges(kwh: str | Column, meter_rent: str | Column, gst_rate: str | Column) -> dict[str, Column]:
    """energy = kWh x 15; gst = (energy + rent) x gst rate; total = sum."""
    energy = _c(kwh).cast(KWH) * F.lit(FLAT_RATE).cast(RATE)
    rent = _c(meter_rent).cast(MONEY)
    gst = (energy + rent) * _c(gst_rate).cast(RATE)
    return {
        "energy_charges": _cents(energy),
        "gst": _cents(gst),
        "total_amount": _cents(energy + rent + gst),
    }


def slab_charge(kwh: str | Column, rates: str | Column) -> Column:
    """Progressive slabs: each (upper, rate) prices the kWh between the
    previous upper bound and its own.  A higher-order ``aggregate`` over the
    tariff's slab array - no UDF.  Returns the energy charge in cents."""
    u = _c(kwh)
    r = _c(rates)
    lowers = F.concat(F.array(F.lit(0.0)), F.slice(F.transform(r, lambda s: s["upper"]), 1, F.size(r) - 1))
    slabs = F.arrays_zip(lowers.alias("lower"), r.alias("slab"))
    acc_type = "decimal(38,7)"

    def add(acc: Column, s: Column) -> Column:
        piece = F.greatest(F.least(u, s["slab"]["upper"]) - s["lower"], F.lit(0.0)).cast(KWH)
        return (acc + piece * s["slab"]["rate"].cast(RATE)).cast(acc_type)
    return _cents(F.aggregate(slabs, F.lit(0).cast(acc_type), add))
