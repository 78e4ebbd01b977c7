"""Text-to-type coercion with "bad value becomes NULL" semantics.

The bronze files are text.  A value that does not parse becomes NULL and the
row is kept; the cleaning step decides what to drop.  Spark's own casts are
close but not identical to what the files' producers expect:

* ``try_cast('5d' as double)`` is 5.0 in Spark, so numbers are guarded by an
  anchored pattern first;
* ``NaN`` would survive ``> 0`` in Spark (NaN sorts above every number), so it
  is mapped to NULL;
* the usual missing-value tokens (``NA``, ``null``, ...) are NULL in every
  column, strings included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default missing-value tokens of pandas.read_csv, which
# produced and consumed these files; they are NULL in every column.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Decimal or scientific number, or an infinity; nothing else (no '5d', no
# '1,000').  The same pattern is valid for Java regex and RE2.
NUMERIC_PATTERN = (
    r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
)

MONTH_FORMAT = "yyyy-M"
# Date and time with a blank or ``T`` between, seconds and fraction optional, an
# offset (``Z``, ``+05:00``) optional; or a bare date.
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd HH:mm[:ss][.SSSSSS][XXX]",
                     "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][XXX]")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c: str | Column) -> Column:
    """NULL for the missing-value tokens, the text otherwise."""
    c = _col(c)
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


# Characters a plain decimal / scientific number can contain.  Text made of
# these alone parses with ``try_cast`` exactly when it matches
# NUMERIC_PATTERN (Java's double grammar minus suffixes, hex and NaN); the
# ``translate`` test is much cheaper than a regex on every value.
_NUMBER_CHARS = "0123456789.+-eE"
_INFINITIES = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity"]


def to_double(c: str | Column) -> Column:
    """Strict numeric parse: NULL for missing tokens, non-numbers and NaN."""
    text = F.trim(na_to_null(c))
    plain = (F.translate(text, _NUMBER_CHARS, "") == "") | F.lower(text).isin(_INFINITIES)
    value = F.when(plain, text.try_cast("double"))
    return F.nanvl(value, F.lit(None).cast("double"))


def parse_month(c: str | Column) -> Column:
    """``YYYY-MM`` (or ``YYYY-M``) to the timestamp of the month's first
    instant; anything else (``2024-13``, trailing text) is NULL."""
    return F.try_to_timestamp(na_to_null(c), F.lit(MONTH_FORMAT))


def parse_timestamp(c: str | Column) -> Column:
    """An ISO date and time (see ``TIMESTAMP_FORMATS``; without an offset in the
    session's zone) or a bare date; NULL otherwise (``x``, ``2024``)."""
    text = na_to_null(c)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in TIMESTAMP_FORMATS])
