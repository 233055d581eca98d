"""Fundamentals chain (CJ3): period pivots, period joins, period filters,
column clean-up and the item-partitioned write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators.clean import drop_if_present, drop_missing_period, keep_recent
from pitpanel.operators.joins import attach_periods
from pitpanel.operators.reshape import pivot_first
from pitpanel.schemas import (CAL1_CODES, CAL2_CODES, PERIOD_KEYS, REPORTED_KEYS,
                              UNNEEDED_PERIOD_COLUMNS)


def calendar_wide(calendar: DataFrame, order_col: str = "ord") -> DataFrame:
    """Calendar periods, one row per (ws_id, point_date, freq, fiscal_period)."""
    return pivot_first(calendar, PERIOD_KEYS, CAL1_CODES, "cal1_", order_col=order_col)


def reported_wide(reported: DataFrame, order_col: str = "ord") -> DataFrame:
    """Reported periods, one row per (ws_id, point_date, freq)."""
    return pivot_first(reported, REPORTED_KEYS, CAL2_CODES, "cal2_", order_col=order_col)


def merged(facts: DataFrame, calendar: DataFrame, reported: DataFrame,
           order_col: str = "ord") -> DataFrame:
    """Facts with their calendar and reported period markers (JN4, JN5)."""
    return attach_periods(facts, calendar_wide(calendar, order_col),
                          reported_wide(reported, order_col))


def final(merged_df: DataFrame) -> DataFrame:
    """FL1 then FL2: drop facts without a reported period, keep the ones
    whose calendar period is the latest reported one."""
    return keep_recent(drop_missing_period(merged_df))


def final_no_cols(merged_df: DataFrame) -> DataFrame:
    """``final`` minus the period markers no later step needs (PR3)."""
    return drop_if_present(final(merged_df), UNNEEDED_PERIOD_COLUMNS)


def fundamentals(facts: DataFrame, calendar: DataFrame, reported: DataFrame,
                 order_col: str = "ord") -> DataFrame:
    """The whole chain as one lineage; nothing is materialised between steps."""
    return final_no_cols(merged(facts, calendar, reported, order_col))


def item_codes(df: DataFrame, item_col: str = "item_code") -> DataFrame:
    """Distinct item codes present (DD3)."""
    return df.select(item_col).distinct().where(F.col(item_col).isNotNull())
