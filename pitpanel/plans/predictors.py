"""Return predictors (CJ7) and predictor-column discovery (CJ10)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pitpanel.operators.formulas import DEFAULT_REGISTRY, apply_registry, registry_codes
from pitpanel.operators.reshape import items_from_wide, items_wide
from pitpanel.plans.lag import with_pit_dates


def predictors(items: DataFrame, registry=DEFAULT_REGISTRY, mode: str = "chain",
               order_cols=None, strict: bool = True, codes=None) -> DataFrame:
    """Items needed by the registry -> one row per company-period -> dates ->
    formulas, all in one lazy plan.

    ``items`` holds EAV rows (ws_id, point_date, freq, fiscal_period,
    cal1_55350, item_code, value); read it from the item-partitioned table
    with ``sources.items.read_items`` so only the needed partitions are
    scanned.
    """
    codes = registry_codes(registry) if codes is None else list(codes)
    wide = items_wide(items, codes, mode=mode, order_cols=order_cols, strict=strict)
    out, _, _ = apply_registry(with_pit_dates(wide), registry)
    return out


def predictors_from_wide(wide: DataFrame, registry=DEFAULT_REGISTRY,
                         strict: bool = True) -> DataFrame:
    """Fallback when no item table exists: take items from ``cal1_<code>``
    columns of the wide table (RS4); predictors lacking inputs are skipped."""
    out, _, _ = apply_registry(with_pit_dates(items_from_wide(wide, strict)), registry)
    return out
