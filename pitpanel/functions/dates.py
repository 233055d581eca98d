"""Date expressions (SF5-SF10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitpanel.functions.text import strip_leading_d, strip_quotes


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, fmt: str, strict: bool = True) -> Column:
    """Parse text to a date (SF5 strict: raises on bad text under ANSI; SF6 lenient: NULL)."""
    return F.to_date(_c(c), fmt) if strict else F.try_to_date(_c(c), fmt)


def to_date_only(c) -> Column:
    """Timestamp -> date (SF7)."""
    return _c(c).cast("date")


def fye_date(c="cal1_55350", strict: bool = True) -> Column:
    """Fiscal-year-end marker text like ``"d20041231"`` -> date."""
    return parse_date(strip_leading_d(strip_quotes(c)), "yyyyMMdd", strict)


def add_months_6(c) -> Column:
    """Date + 6 calendar months, clamped to month end (SF8)."""
    return F.add_months(_c(c), 6)


def day_diff(end, start) -> Column:
    """Whole days from ``start`` to ``end`` as bigint (SF9)."""
    return F.datediff(_c(end), _c(start)).cast("bigint")
