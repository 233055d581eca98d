"""Text clean-up expressions (SF1, SF3, SF4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitpanel.schemas import HEADER_DATE_PATTERN



def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_quotes(c) -> Column:
    """Remove every double quote (SF3)."""
    return F.translate(_c(c), '"', "")


def strip_leading_d(c) -> Column:
    """Remove one leading ``d`` (SF4), as in fiscal-year-end markers."""
    return F.regexp_replace(_c(c), r"^d", "")


def header_date_text(c) -> Column:
    """``dd/MM/yyyy`` prefix of a header; NULL when the header is not a date (SF1).

    ``regexp_extract`` yields '' on no match, so it is turned into NULL.
    """
    return F.nullif(F.regexp_extract(_c(c), HEADER_DATE_PATTERN, 1), F.lit(""))
