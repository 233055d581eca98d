"""Point-in-time lag analysis (CJ4-CJ6): how many days after the fiscal
year end a figure was known, against the six-month availability rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions import add_months_6, day_diff, fye_date, to_date_only
from pitpanel.operators.clean import lag_after, lag_on_or_before
from pitpanel.operators.joins import attach_year_bins
from pitpanel.operators.stats import availability_panel, distribution_panel, sign_counts


def with_pit_dates(df: DataFrame, marker: str = "cal1_55350", strict: bool = True) -> DataFrame:
    """Add ``fye_date`` (parsed marker), ``pit_date`` and ``ff92_date`` (+6 months)."""
    return (df.withColumns({"fye_date": fye_date(marker, strict),
                            "pit_date": to_date_only("point_date")})
            .withColumn("ff92_date", add_months_6("fye_date")))


def lag_features(df: DataFrame, strict: bool = True) -> DataFrame:
    """Dates, day lags, fiscal year and its bin (SF3-SF11, JN6)."""
    d = with_pit_dates(df, strict=strict)
    d = d.withColumns({"diff_to_fye": day_diff("pit_date", "fye_date"),
                       "diff_to_ff92": day_diff("pit_date", "ff92_date"),
                       "fye_year": F.year("fye_date")})
    return attach_year_bins(d)


def lag_histogram(features: DataFrame) -> DataFrame:
    """Rows ``n`` per bin and pair of day lags: what every panel needs of the facts, combined
    map-side and bounded by bins and days, not by rows. Panels take it with ``count_col="n"``."""
    return features.groupBy("fye_bin", "diff_to_fye", "diff_to_ff92").agg(F.count(F.lit(1)).alias("n"))


def panel_a(features: DataFrame, std_digits=None, count_col=None) -> DataFrame:
    """Distribution of days from fiscal year end to availability, per bin."""
    return distribution_panel(features, "fye_bin", "diff_to_fye", std_digits, count_col=count_col)


def panel_b(features: DataFrame, std_digits=None, count_col=None) -> DataFrame:
    """Distribution of days from the six-month date to availability, per bin."""
    return distribution_panel(features, "fye_bin", "diff_to_ff92", std_digits, count_col=count_col)


def panel_c(features: DataFrame, count_col=None) -> DataFrame:
    """Share of company-periods not yet known at the six-month date, per bin."""
    return availability_panel(features, "fye_bin", "diff_to_ff92", count_col)


def panel_after(features: DataFrame, std_digits=None, count_col=None) -> DataFrame:
    return distribution_panel(lag_after(features), "fye_bin", "diff_to_ff92", std_digits, count_col=count_col)


def panel_before(features: DataFrame, std_digits=None, count_col=None) -> DataFrame:
    return distribution_panel(lag_on_or_before(features), "fye_bin", "diff_to_ff92", std_digits, count_col=count_col)


def lag_counts(features: DataFrame, count_col=None) -> DataFrame:
    return sign_counts(features, "diff_to_ff92", count_col)
