"""Reshape operators: unpivot dates (RS1), first-value pivot (RS2),
items to one row per company-period (RS3) and the wide fallback (RS4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions import to_number
from pitpanel.schemas import FYE_CODE, ITEM_KEYS, ITEM_NAMES, item_column


def unpivot_dates(df: DataFrame, id_cols, value_cols=None, n_meta: int = 7,
                  name_col: str = "Date", value_col: str = "Value") -> DataFrame:
    """Wide frame (one column per date header) -> long ``(ids, name, value)``.

    ``value_cols`` defaults to every column from position ``n_meta`` on.
    NULL cells are kept. Plans as one ``Expand`` per input row: no shuffle.
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    vals = list(value_cols) if value_cols is not None else df.columns[n_meta:]
    return df.unpivot(ids, vals, name_col, value_col)


def pivot_first(df: DataFrame, keys, codes, prefix: str, item_col: str = "item_code",
                value_col: str = "value", order_col: str = "ord") -> DataFrame:
    """EAV -> wide, one column ``<prefix><code>`` per declared code (RS2, AG9).

    Per key and code the value of the row with the smallest ``order_col``
    is taken (the first in file order); a NULL first value stays NULL.
    One hash aggregation, partial before the shuffle, so a hot key is
    combined map-side. The code list is declared, so no job is spent on
    discovering pivot values and the schema is fixed.
    """
    item = F.col(item_col)
    aggs = [F.min_by(F.when(item == c, F.col(value_col)),
                     F.when(item == c, F.col(order_col))).alias(f"{prefix}{c}")
            for c in codes]
    return df.groupBy(*keys).agg(*aggs)


def _item_part(df, code, keys, value_col, item_col, strict):
    return (df.where(F.col(item_col) == code)
            .select(*keys, to_number(value_col, strict).alias(item_column(code))))


def items_wide(df: DataFrame, codes, mode: str = "chain", keys=ITEM_KEYS,
               item_col: str = "item_code", value_col: str = "value",
               order_cols=None, strict: bool = True) -> DataFrame:
    """Items of ``codes`` to one row per company-period (JN7 / RS3).

    ``chain``: inner equi-joins of one part per item on ``keys`` — the
    faithful form: duplicates of a (key, item) multiply and NULL keys drop;
    one shuffle per item part.
    ``split``: the rows of ``chain``, but company-periods whose items are all
    unique come from one aggregation and only the others are joined.
    ``pivot``: one grouped aggregation (a single shuffle, partial before
    it); fails when a (key, item) has several rows.
    ``dedup``: per (key, item) the value of the first row by ``order_cols``
    (ties: smallest value), inside the same single aggregation.
    A company-period appears only when every item has a row (presence by
    row, not by non-NULL value).
    """
    codes = [int(c) for c in codes]
    if mode == "chain":
        parts = [_item_part(df, c, keys, value_col, item_col, strict) for c in codes]
        return reduce(lambda a, b: a.join(b, list(keys), "inner"), parts)
    item = F.col(item_col)
    num = to_number(value_col, strict)
    rows_of = {c: F.count_if(item == c) for c in codes}
    if mode == "split":
        wide = (df.where(item.isin(codes))
                .where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
                .groupBy(*keys)
                .agg(*[F.max(F.when(item == c, num)).alias(item_column(c)) for c in codes],
                     F.least(*rows_of.values(), F.lit(1)).alias("_least"),
                     F.greatest(*rows_of.values(), F.lit(1)).alias("_most"))
                .where("_least = 1"))
        several = wide.where("_most > 1").select(*keys)
        return (wide.where("_most = 1").drop("_least", "_most")
                .unionByName(items_wide(df.join(several, list(keys), "left_semi"), codes, "chain", keys,
                                        item_col, value_col, strict=strict)))
    if mode == "pivot":
        pick = [F.when(rows_of[c] > 1, F.raise_error(F.lit(f"item {c} has several rows in a company-period")))
                .otherwise(F.max(F.when(item == c, num))).cast("double").alias(item_column(c)) for c in codes]
    elif mode == "dedup":
        # Only the picked value is output, so ties on the order columns are
        # broken by the value itself: deterministic, and a small sort key.
        order = list(order_cols or [])
        rank = F.struct(*[F.col(c) for c in order + [value_col]])
        pick = [F.min_by(F.when(item == c, num), F.when(item == c, rank)).alias(item_column(c))
                for c in codes]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    present = reduce(lambda a, b: a & b, [F.col(f"_has_{c}") for c in codes])
    return (df.where(item.isin(codes))
            .where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys)
            .agg(*pick, *[(rows_of[c] > 0).alias(f"_has_{c}") for c in codes])
            .where(present)
            .drop(*[f"_has_{c}" for c in codes]))


def items_from_wide(df: DataFrame, strict: bool = True) -> DataFrame:
    """Wide fallback (RS4): every ``cal1_<code>`` of a known item becomes its
    item column (cast to double)."""
    present = {f"cal1_{code}": name for code, name in ITEM_NAMES.items()
               if f"cal1_{code}" in df.columns and int(code) != FYE_CODE}
    if not present:
        return df
    return df.withColumns({name: to_number(src, strict) for src, name in present.items()})
