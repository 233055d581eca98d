"""Portfolios per fiscal-year bin and country, joined to returns (OP2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.operators import portfolios as po
from pitpanel.operators.joins import attach_matching
from pitpanel.schemas import COMPANY_COLUMN, COUNTRY_COLUMN

GROUPS = ["predictor", "fye_bin", COUNTRY_COLUMN]


def matched_returns(prices: DataFrame, matching: DataFrame) -> DataFrame:
    """Returns per security and day with the security's company and country (fan-out as in JN3)."""
    return attach_matching(po.index_returns(prices), matching)


def returns_joined(prices: DataFrame, matching: DataFrame, predictors: DataFrame, names, hold_months: int = 12) -> DataFrame:
    """Every return on a day on which its company's predictors hold, with the spell's predictors."""
    return po.held_days(matched_returns(prices, matching), po.holding_spells(predictors, names, hold_months))


def company_countries(matching: DataFrame) -> DataFrame:
    """(company, country): the smallest country of a company's matching rows."""
    return (matching.where(F.col(COMPANY_COLUMN).isNotNull()).groupBy(F.col(COMPANY_COLUMN).alias("company"))
            .agg(F.min(COUNTRY_COLUMN).alias(COUNTRY_COLUMN)))


def formation(predictors: DataFrame, matching: DataFrame, names, hold_months: int = 12) -> DataFrame:
    """One row per company, holding spell and predictor: its bin, country and value."""
    spells = po.holding_spells(predictors, names, hold_months).join(company_countries(matching), "company", "left")
    return po.long_predictors(spells, names, ["company", "from_date", "to_date", "fye_bin", COUNTRY_COLUMN])


def members(formed: DataFrame, n_groups: int = 5) -> DataFrame:
    """``formation`` rows with their portfolio within predictor, bin and country."""
    return po.assign_groups(formed, po.breakpoints(formed, GROUPS, n_groups), GROUPS)


def portfolio_returns(prices: DataFrame, matching: DataFrame, assigned: DataFrame) -> DataFrame:
    """Mean returns per predictor, bin, country, portfolio and day. ``assigned``: ``members`` rows.

    A company's spell carries its portfolios of all predictors as one array (as many as there are
    predictors), so returns are joined once, not once a predictor."""
    spell = ["company", "from_date", "to_date", "fye_bin", COUNTRY_COLUMN]
    held = po.held_days(
        matched_returns(prices, matching).drop(COUNTRY_COLUMN),
        assigned.groupBy(*spell).agg(F.collect_list(F.struct("predictor", "portfolio")).alias("p")))
    rows = held.select("fye_bin", COUNTRY_COLUMN, "Date", "ret", "weight", F.inline("p"))
    return po.portfolio_means(rows, [*GROUPS, "portfolio", "Date"])


def spreads(returns: DataFrame, n_groups: int = 5) -> DataFrame:
    """Per predictor, bin and country: days with both outer portfolios, and the mean of highest minus lowest."""
    outer = returns.where(F.col("portfolio").isin(1, n_groups)).groupBy(*GROUPS, "Date").agg(*[
        F.max(F.when(F.col("portfolio") == g, F.col(f"{kind}_return"))).alias(f"{kind}_{g}")
        for kind in ("ew", "vw") for g in (1, n_groups)])
    gap = {kind: F.col(f"{kind}_{n_groups}") - F.col(f"{kind}_1") for kind in ("ew", "vw")}
    return outer.groupBy(*GROUPS).agg(F.count(gap["ew"]).alias("n_days"), F.avg(gap["ew"]).alias("ew_spread"),
                                      F.avg(gap["vw"]).alias("vw_spread"))
