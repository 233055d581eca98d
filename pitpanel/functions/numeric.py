"""Numeric casts and rounding (PR5, PR6, SF12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitpanel.functions.text import strip_quotes


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A cast to double alone would also take Java's suffixes ("12d", "1f").
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lenient_double(c) -> Column:
    """Text -> double, NULL when the text is not a number (PR5)."""
    return F.when(_c(c).rlike(NUMBER), _c(c).try_cast("double"))


def strict_double(c) -> Column:
    """Text -> double; text that is not a number raises (PR6)."""
    text = _c(c).cast("string")
    return F.when(text.isNull() | text.rlike(NUMBER), _c(c).cast("double")) \
        .otherwise(F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double"))


def whole_number(c) -> Column:
    """Text -> bigint; "2003.0" is 2003, text that is no whole number is NULL."""
    d = _c(c).try_cast("decimal(38,6)")
    return F.when(d == F.floor(d), d).try_cast("bigint")


def to_number(c, strict: bool = True) -> Column:
    """Vendor value text (may carry quotes) -> double."""
    s = strip_quotes(c)
    return strict_double(s) if strict else lenient_double(s)


def round_half_up(c, digits: int = 1) -> Column:
    """Round half away from zero (SF12)."""
    return F.round(_c(c), digits)
