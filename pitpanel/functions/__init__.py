"""Column expressions (JVM-side built-ins only, no Python UDFs)."""

from pitpanel.functions.dates import (add_months_6, day_diff, fye_date, parse_date,
                                      to_date_only)
from pitpanel.functions.numeric import lenient_double, round_half_up, strict_double, to_number
from pitpanel.functions.text import header_date_text, strip_leading_d, strip_quotes
from pitpanel.functions.bins import year_bin, year_bins_frame

__all__ = [
    "add_months_6", "day_diff", "fye_date", "parse_date", "to_date_only",
    "lenient_double", "strict_double", "to_number", "round_half_up",
    "header_date_text", "strip_leading_d", "strip_quotes",
    "year_bin", "year_bins_frame",
]
