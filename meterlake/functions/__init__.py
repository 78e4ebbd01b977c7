"""Column expressions.  Everything here returns a ``Column`` and stays inside
whole-stage codegen (no Python UDFs)."""

from meterlake.functions.coerce import (  # noqa: F401
    NA_TOKENS, NUMERIC_PATTERN, na_to_null, parse_month, parse_timestamp, to_double,
)
