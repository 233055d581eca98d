"""Declared schemas and fixed values of the data model.

Everything here is declared up front so no job is spent on inference or on
discovering pivot values, and every output schema is stable.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# ---------------------------------------------------------------------------
# Fixed values (must equal the vendor layout for correct results).
# ---------------------------------------------------------------------------

# Column layout of the pipe-delimited fundamentals files, by file kind.
_VALUE6 = ["ws_id", "point_date", "freq", "fiscal_period", "item_code", "value"]
_NOTE6 = ["ws_id", "point_date", "freq", "fiscal_period", "item_code", "note"]
_VALUE4 = ["ws_id", "point_date", "item_code", "value"]
_NOTE4 = ["ws_id", "point_date", "item_code", "note"]
FUNDAMENTALS_LAYOUT = {
    "WSCalendarPrd": _VALUE6,
    "WSCurrent": _VALUE4,
    "WSCurrentFootnote": _NOTE4,
    "WSFV": _VALUE6,
    "WSFVFootnote": _NOTE6,
    "WSIndex": ["ws_id", "point_date", "index_name", "item_code", "value"],
    "WSMetaData": _VALUE6,
    "WSMetaDataFootnote": _NOTE6,
    "WSMonthlyPricing": _VALUE4,
    "WSMonthlyPricingFootnote": _NOTE4,
    "WSRatios": _VALUE6,
    "WSRatiosFootnote": _NOTE6,
    "WSReportedPrd": ["ws_id", "point_date", "freq", "item_code", "value"],
    "WSSegment": ["ws_id", "point_date", "freq", "fiscal_period", "segment_type",
                  "segment_id", "item_code", "value"],
    "WSSegmentFootnote": ["ws_id", "point_date", "freq", "fiscal_period", "segment_type",
                          "segment_id", "item_code", "note"],
    "WSSupplemental": _VALUE6,
    "WSSupplementalFootnote": _NOTE6,
    "WSWeeklyPricing": _VALUE4,
    "WSWeeklyPricingFootnote": _NOTE4,
}

# Item code -> short column name used by predictor formulas.
ITEM_NAMES = {
    5490: "BE", 2003: "Cash", 1051: "COGS", 2201: "CA", 3101: "CL", 9502: "DivP",
    5255: "EPS", 8698: "SGx", 2649: "Intan", 2101: "Inv", 18199: "NDebt", 6895: "NI",
    6620: "PPE", 1401: "PreTax", 5006: "Price", 7240: "Sales", 1101: "SGA",
    3051: "STD", 1451: "Tax", 6699: "TA", 3351: "TL",
}

# Calendar-period item codes (pivoted to cal1_<code>) and reported-period
# item codes (pivoted to cal2_<code>).
CAL1_CODES = [55350, 55352, 55555, 57034]
CAL2_CODES = [55558, 55559]
FYE_CODE = 55350            # fiscal year end marker, text like "d20041231"
# Columns dropped after the period filters.
UNNEEDED_PERIOD_COLUMNS = ["cal1_57034", "cal1_55352", "cal1_55555", "cal2_55558"]

# Year bins: (first year, last year, label); years 1970..2029 outside these
# ranges are "Other", anything else (or null) has no bin. Labels use an en dash.
YEAR_BIN_RANGE = (1970, 2029)
YEAR_BINS = [
    (1990, 1994, "1990–1994"),
    (1995, 1999, "1995–1999"),
    (2000, 2004, "2000–2004"),
    (2005, 2009, "2005–2009"),
    (2010, 2014, "2010–2014"),
    (2015, 2018, "2015–2018"),
]
OTHER_BIN = "Other"

# Identifier and date columns of the predictor table, excluded when looking
# for predictor (numeric) columns.
PREDICTOR_META_COLUMNS = {"ws_id", "point_date", "freq", "fiscal_period", "cal1_55350",
                          "pit_date", "fye_date", "ff92_date"}

# Keys.
PERIOD_KEYS = ["ws_id", "point_date", "freq", "fiscal_period"]
REPORTED_KEYS = ["ws_id", "point_date", "freq"]
ITEM_KEYS = ["ws_id", "point_date", "freq", "fiscal_period", "cal1_55350"]
MATCH_KEYS = ["DSCD", "WC06105"]
SECURITY_KEYS = ["DSCode", "Currency"]
PRICE_KEYS = ["DSCode", "Date", "Currency"]
MATCH_COLUMNS = ["DSCD", "ISIN", "LOC", "GEOGC", "WC06105", "TIME"]
PRICE_META_COLUMNS = 7      # wide price files: date columns start at index 7
PRICE_ID_COLUMN = "DATES"   # header cell naming the security-code column
# Date part of a price-file header such as "01/02/2003_duplicated_0".
HEADER_DATE_PATTERN = r"^(\d{2}/\d{2}/\d{4}).*"
# Leg tags in price file names; removing them leaves the suffix that pairs files.
LEG_TAG_PATTERN = r"Daily(MV|Returns)(USD|LC)"
# Folders whose name contains this hold index files, which are skipped.
INDEX_FOLDER_MARK = "Index Returns"
# Currency tags looked up in the data-relative path, in this order; otherwise "Unknown".
CURRENCY_TAGS = ("LC", "USD")
# Portfolio step: a panel's company and country columns; the predictor table's company, the date from
# which a predictor holds, the date it was known and the fiscal year's end.
COMPANY_COLUMN, COUNTRY_COLUMN = "WC06105", "GEOGC"
PREDICTOR_COMPANY, HOLD_FROM, PIT_DATE, FYE_DATE = "ws_id", "ff92_date", "pit_date", "fye_date"
# Names of the lag panels' files and of their columns.
PANEL_FILES = {
    "a": "panel_A_diff_pit_to_fye",
    "b": "panel_B_diff_pit_to_ff92",
    "c": "panel_C_availability_at_FF92",
    "after": "panel_after_ff92_only",
    "before": "panel_before_ff92_only",
    "counts": "lag_counts",
}
DISTRIBUTION_COLUMNS = ("Mean", "Median", "StdDev", "10thPct", "90thPct")
AVAILABILITY_COLUMNS = ("N", "FF92_not_available", "Pct_FF92_not_avail", "Data_available_by_FF92", "Pct_data_avail_by_FF92")
# File-name tag of the market-value leg (otherwise the return-index leg, "RI").
MV_TAG = "MV"

# ---------------------------------------------------------------------------


def fundamentals_schema(kind: str) -> T.StructType:
    """All-string schema for one fundamentals file kind (cast at use)."""
    try:
        cols = FUNDAMENTALS_LAYOUT[kind]
    except KeyError as e:
        raise ValueError(f"unknown fundamentals kind {kind!r}") from e
    return T.StructType([T.StructField(c, S, True) for c in cols])


def string_schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, S, True) for c in cols])


def item_column(code: int) -> str:
    return ITEM_NAMES.get(int(code), f"item_{int(code)}")
