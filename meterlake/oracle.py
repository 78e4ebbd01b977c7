"""Independent SQL statements of what each registered query must return.

Written for DuckDB over the same test tables.  The bronze stand-ins are
stated here directly in *typed* form: a text fault such as ``abc``, ``5d``,
``NA``, ``NaN`` or ``2024-13`` is simply NULL, which is what the Spark
coercion must arrive at by parsing the text.
"""

from __future__ import annotations

_BILL_ORDER = ("source_file, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
               "l_discount, l_tax, l_returnflag, l_linestatus")

CTES = {
    "bills_typed": f"""
bills_typed AS (
  SELECT
    CASE WHEN l.l_orderkey % 211 = 0 THEN NULL
         ELSE CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) END AS bill_id,
    lpad(CAST(o.o_custkey AS VARCHAR), 12, '0') AS meter_id,
    CASE WHEN l.l_orderkey % 79 = 0 THEN NULL ELSE date_trunc('month', l.l_shipdate) END AS billing_month,
    CASE WHEN l.l_orderkey % 97 = 0 OR l.l_orderkey % 101 = 0 THEN NULL ELSE l.l_quantity END AS consumption_kwh,
    CASE WHEN l.l_orderkey % 73 = 0 THEN NULL ELSE l.l_extendedprice END AS energy_charges,
    l.l_discount * 100 AS meter_rent,
    l.l_extendedprice * l.l_tax AS gst,
    CASE WHEN l.l_orderkey % 89 = 0 OR l.l_orderkey % 83 = 0 THEN NULL
         ELSE l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) * sign(c.c_acctbal) END AS total_amount,
    CASE l.l_returnflag WHEN 'N' THEN 'Paid' WHEN 'A' THEN 'Unpaid' ELSE 'Late' END AS status,
    r.r_name AS division,
    n.n_name AS subdivision,
    r.r_name || '/' || n.n_name || '/bills/bills.tsv' AS source_file,
    l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_partkey, l.l_suppkey, l.l_quantity,
    l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, c.c_acctbal
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "bills_first": f"""
bills_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY bill_id ORDER BY {_BILL_ORDER}) AS rn
    FROM bills_typed) WHERE rn = 1
)""",
    "bills": """
bills AS (
  SELECT * FROM bills_first WHERE consumption_kwh IS NOT NULL AND total_amount > 0
)""",
    "readings_typed": """
readings_typed AS (
  SELECT
    CASE WHEN e.event_id % 97 = 0 OR e.event_id % 101 = 0 THEN NULL
         ELSE date_trunc('hour', e.ts) END AS "timestamp",
    lpad(CAST(e.user_id AS VARCHAR), 12, '0') AS meter_id,
    CASE WHEN e.event_id % 89 = 0 THEN NULL ELSE e.value + 1000 END AS reading,
    CASE WHEN e.event_id % 83 = 0 THEN NULL ELSE e.value - 5 END AS consumption_kwh,
    CAST(170 + CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS DOUBLE) AS voltage,
    CASE WHEN 170 + CAST(json_extract_string(e.props, '$.k') AS INTEGER) > 0
         THEN (e.value - 5) / (CAST(170 + CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS DOUBLE) / 1000)
         ELSE 0.0 END AS current_amp,
    CASE WHEN e.event_type = 'error' THEN 'ISSUE' ELSE 'OK' END AS quality_flag,
    'DIV' || lpad(CAST(e.user_id % 5 AS VARCHAR), 2, '0') AS division,
    'SUB' || lpad(CAST(e.user_id % 25 AS VARCHAR), 2, '0') AS subdivision,
    'DIV' || lpad(CAST(e.user_id % 5 AS VARCHAR), 2, '0') || '/' ||
      'SUB' || lpad(CAST(e.user_id % 25 AS VARCHAR), 2, '0') || '/readings/readings.csv' AS source_file,
    e.event_id, e.ts, e.user_id, e.value, e.event_type
  FROM events e
)""",
    "readings_first": """
readings_first AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY "timestamp", meter_id ORDER BY source_file, event_id) AS rn
    FROM readings_typed) WHERE rn = 1
)""",
    "readings": """
readings AS (
  SELECT * FROM readings_first
  WHERE "timestamp" IS NOT NULL AND reading IS NOT NULL
    AND voltage BETWEEN 180 AND 260 AND consumption_kwh >= 0
)""",
}

_DEPS = {
    "bills_first": ["bills_typed"],
    "bills": ["bills_typed", "bills_first"],
    "readings_first": ["readings_typed"],
    "readings": ["readings_typed", "readings_first"],
}


def with_(*names: str) -> str:
    """``WITH`` clause holding the named CTEs and what they depend on."""
    order: list[str] = []
    for n in names:
        for d in _DEPS.get(n, []) + [n]:
            if d not in order:
                order.append(d)
    return "WITH " + ",".join(CTES[n] for n in order) + "\n"


def ts_text(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def batch_ctes(kind: str) -> str:
    """CTEs ``<kind>_b1`` / ``<kind>_b2``: each arrival batch cleaned on its
    own (keep-first, then filters), as the loads do."""
    if kind == "bills":
        typed, key, order = "bills_typed", "bill_id", _BILL_ORDER
        b1 = "l_shipdate < TIMESTAMP '1998-01-01'"
        valid = "consumption_kwh IS NOT NULL AND total_amount > 0"
    else:
        typed, key, order = "readings_typed", '"timestamp", meter_id', "source_file, event_id"
        b1 = "quality_flag = 'OK'"
        valid = ('"timestamp" IS NOT NULL AND reading IS NOT NULL AND voltage BETWEEN 180 AND 260 '
                 "AND consumption_kwh >= 0")
    parts = []
    for name, cond in (("b1", b1), ("b2", f"NOT ({b1})")):
        parts.append(f"""
{kind}_{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
    FROM {typed} WHERE {cond}) WHERE rn = 1 AND {valid}
)""")
    return ",".join(parts)


def _tariff_values() -> tuple[str, str]:
    from meterlake.sources.dimensions import TARIFFS
    t_rows, s_rows = [], []
    for code, name, rates, rent, service, gst in TARIFFS:
        t_rows.append(f"('{code}', '{name}', CAST({rent} AS DOUBLE), CAST({service} AS DOUBLE), "
                      f"CAST({gst} AS DOUBLE))")
        lower = 0.0
        for upper, rate in rates:
            up = "CAST('inf' AS DOUBLE)" if upper == float("inf") else f"CAST({upper} AS DOUBLE)"
            s_rows.append(f"('{code}', CAST({lower} AS DOUBLE), {up}, CAST({rate} AS DOUBLE))")
            lower = upper
    return ", ".join(t_rows), ", ".join(s_rows)


def _segment_case(col: str) -> str:
    from meterlake.sources.dimensions import SEGMENT_TARIFF
    whens = " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in SEGMENT_TARIFF.items())
    return f"CASE {col} {whens} ELSE 'A-1a(02)' END"


_T, _S = None, None


def _dims() -> None:
    global _T, _S
    if _T is None:
        _T, _S = _tariff_values()
        CTES["tariffs"] = f"""
tariffs AS (SELECT * FROM (VALUES {_T}) t(tariff_code, name, meter_rent, service_rent, gst_rate))"""
        CTES["slabs"] = f"""
slabs AS (SELECT * FROM (VALUES {_S}) s(tariff_code, lower_kwh, upper_kwh, rate))"""
        CTES["meters"] = f"""
meters AS (
  SELECT printf('%012d', c.c_custkey) AS meter_id, r.r_name AS division, n.n_name AS subdivision,
         c.c_mktsegment AS area, {_segment_case('c.c_mktsegment')} AS tariff_code,
         CASE WHEN c.c_acctbal > 0 THEN 'Active' ELSE 'Inactive' END AS status
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""
        CTES["customers"] = """
customers AS (
  SELECT 'CUST' || printf('%08d', c_custkey) AS customer_id, printf('%012d', c_custkey) AS meter_id,
         c_name AS name,
         CASE WHEN c_acctbal < 0 THEN 'defaulter' WHEN c_acctbal < 2000 THEN 'late_payer'
              WHEN c_acctbal < 5000 THEN 'regular_payer' ELSE 'prompt_payer' END AS payment_behavior
  FROM customer)"""
        CTES["usage"] = """
usage AS (
  SELECT meter_id, date_trunc('month', "timestamp") AS period, round(sum(consumption_kwh), 3) AS kwh,
         count(*) AS n_readings
  FROM readings WHERE meter_id IS NOT NULL GROUP BY meter_id, date_trunc('month', "timestamp"))"""
        _DEPS["usage"] = ["readings_typed", "readings_first", "readings"]


_dims()

CTES["log"] = """
log AS (
  SELECT ts, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' WHEN 'click' THEN 'DEBUG'
              ELSE 'INFO' END AS level,
         'event ' || CAST(event_id AS VARCHAR) || ' ' || event_type || ' user=' || CAST(user_id AS VARCHAR) AS message
  FROM events)"""
