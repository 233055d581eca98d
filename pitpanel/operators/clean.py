"""Projection, filter and de-duplication operators (PR2, PR3, FL1-FL4, DD1-DD3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_if_present(df: DataFrame, cols) -> DataFrame:
    """Drop the columns that exist; absent names are ignored (PR3)."""
    return df.drop(*cols)


def drop_missing_period(df: DataFrame, a: str = "cal2_55558", b: str = "cal2_55559") -> DataFrame:
    """Drop rows whose two reported-period markers are both ``'0'`` (FL1).

    Three-valued: a row is kept only when the condition is TRUE, so
    (NULL, '0') and (NULL, NULL) are dropped while (NULL, '1') is kept.
    """
    return df.where(~((F.col(a) == "0") & (F.col(b) == "0")))


def keep_recent(df: DataFrame, a: str = "cal1_55555", b: str = "cal2_55559") -> DataFrame:
    """Keep rows whose calendar marker equals the reported marker (FL2); NULL drops."""
    return df.where(F.col(a) == F.col(b))


def lag_after(df: DataFrame, col: str = "diff_to_ff92") -> DataFrame:
    """Rows known after the six-month date (FL3); NULL lags are in neither side."""
    return df.where(F.col(col) > 0)


def lag_on_or_before(df: DataFrame, col: str = "diff_to_ff92") -> DataFrame:
    return df.where(F.col(col) <= 0)


def _desc_key(c: str, dtype) -> F.Column:
    col = F.col(c)
    if isinstance(dtype, T.DateType):
        return -F.unix_date(col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return -F.unix_micros(col.cast("timestamp"))
    if isinstance(dtype, T.NumericType):
        return -col
    raise TypeError(f"descending order key needs a date, timestamp or number: {c}")


def first_row_per_key(df: DataFrame, keys, order_cols, descending=()) -> DataFrame:
    """One row per ``keys``: the smallest by ``order_cols`` then by the rest of
    the row, so ties are broken deterministically.

    Columns named in ``descending`` sort descending with NULLs last; the
    others ascending with NULLs first. Expressed as ``min(struct(...))``,
    a plain aggregate: it is combined map-side before the shuffle, so a key
    holding a large share of the rows never lands in one task whole.
    """
    keys = list(keys)
    order_cols = list(order_cols)
    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    fields = []
    for i, c in enumerate(order_cols):
        if c in descending:
            fields.append(F.col(c).isNull().alias(f"_o{i}n"))
            fields.append(_desc_key(c, types[c]).alias(f"_o{i}"))
        else:
            fields.append(F.col(c).alias(f"_o{i}"))
    fields += [F.col(c).alias(f"_r_{c}") for c in order_cols + rest]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_pick"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_pick._r_{c}").alias(c)
                           for c in df.columns])


def latest_per_key(df: DataFrame, keys, ts_col: str, tie_cols=()) -> DataFrame:
    """Keep the most recent row per key by ``ts_col`` (DD1), NULL dates last,
    ties broken by ``tie_cols`` and then the rest of the row. NULL keys form
    one group."""
    return first_row_per_key(df, keys, [ts_col, *tie_cols], descending=(ts_col,))


def dedup_rows(df: DataFrame, keys) -> DataFrame:
    """One row per key without a date (DD2): the smallest full row."""
    return first_row_per_key(df, keys, [])
