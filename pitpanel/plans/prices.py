"""Price side (CJ1, CJ2): legs -> paired join -> union -> matching table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions import header_date_text, lenient_double, parse_date
from pitpanel.operators.clean import dedup_rows, latest_per_key
from pitpanel.operators.joins import attach_matching, join_legs
from pitpanel.schemas import MATCH_KEYS


def matching_table(raw: DataFrame, keys=MATCH_KEYS, time_col: str = "TIME",
                   tie_cols=("ISIN",)) -> DataFrame:
    """Latest matching row per (DSCD, WC06105) by the day/month/year TIME
    text, padded or not (DD1, SF6); unparseable dates sort last. Without a TIME column the
    smallest full row per key is kept (DD2)."""
    if time_col not in raw.columns:
        return dedup_rows(raw, keys)
    t = raw.withColumn("_t", parse_date(time_col, "d/M/yyyy", strict=False))
    ties = [c for c in tie_cols if c in raw.columns]
    return latest_per_key(t, keys, "_t", ties).drop("_t")


def union_legs(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column missing in a frame is NULL (SO1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def price_panel(ri: DataFrame, mv: DataFrame, matching: DataFrame | None = None,
                pairs: DataFrame | None = None) -> DataFrame:
    """Paired return/market-value panel, optionally with the matching columns."""
    panel = join_legs(ri, mv, pairs=pairs).drop("suffix")
    if matching is not None:
        panel = attach_matching(panel, matching)
    return panel


def long_prices(wide_long: DataFrame, value_name: str, currency: str | None = None,
                date_text: str = "Date", value_text: str = "Value") -> DataFrame:
    """Long rows from an unpivoted wide frame: header text -> date (strict
    ``dd/MM/yyyy`` on the extracted prefix; non-date headers give NULL),
    cell text -> double (lenient)."""
    out = wide_long.withColumns({
        date_text: parse_date(header_date_text(date_text), "dd/MM/yyyy", strict=True),
        value_name: lenient_double(value_text)})
    if currency is not None:
        out = out.withColumn("Currency", F.lit(currency))
    return out.drop(value_text) if value_text != value_name else out
