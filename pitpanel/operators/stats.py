"""Grouped statistics of the lag panels (AG1-AG10, ST1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.schemas import AVAILABILITY_COLUMNS, DISTRIBUTION_COLUMNS


def _histogram(df: DataFrame, group_col: str, value_col: str, count_col: str | None = None) -> DataFrame:
    """``(group, value, count)`` with a running count of non-NULL values per
    group (``_cum``) and the group's non-NULL total (``_n``).

    The grouped count is combined map-side, so what is shuffled is at most
    one row per (task, group, distinct value); the window then holds one
    group's distinct values — for day lags bounded by the number of days
    in the data's date range, whatever the row count. NULL values keep a
    row (count 0 in the running sums) so all-NULL groups still appear.
    """
    v = F.col(value_col)
    if not isinstance(df.schema[value_col].dataType, T.IntegralType):
        raise TypeError(f"{value_col} must be integral (a day count); got {df.schema[value_col].dataType}")
    hist = df.groupBy(group_col, value_col).agg(F.sum(_weight(count_col)).alias("_c"))
    nn = F.when(v.isNotNull(), F.col("_c")).otherwise(F.lit(0))
    w_cum = Window.partitionBy(group_col).orderBy(F.col(value_col).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (hist.withColumn("_nn", nn)
            .withColumn("_cum", F.sum("_nn").over(w_cum))
            .withColumn("_n", F.sum("_nn").over(Window.partitionBy(group_col))))


def _weight(count_col: str | None):
    """Rows that one input row stands for: ``count_col`` (an input already grouped), else one."""
    return F.col(count_col) if count_col else F.lit(1).cast("bigint")


def _value_at_rank(rank, value_col: str):
    """Smallest value whose running count reaches ``rank`` (1-based)."""
    return F.min(F.when((F.col("_nn") > 0) & (F.col("_cum") >= rank), F.col(value_col)))


def _nearest_rank(q: float):
    # rank round((n-1)·q)+1, half away from zero, over the n non-NULL values
    return F.round((F.col("_n") - 1) * F.lit(float(q)), 0) + 1


INTERPOLATIONS = ("nearest", "lower", "higher", "midpoint", "linear")


def _quantile(q: float, value_col: str, interpolation: str = "nearest"):
    """Aggregate expression over a ``_histogram`` frame: quantile ``q`` of the
    group's non-NULL values. With p = (n-1)·q (0-based position): nearest =
    rank round(p)+1; lower/higher = ranks floor(p)+1 / ceil(p)+1; midpoint =
    their mean; linear = lower + (p - floor(p)) · (higher - lower)."""
    if interpolation == "nearest":
        return _value_at_rank(_nearest_rank(q), value_col).cast("double")
    p = (F.col("_n") - 1) * F.lit(float(q))
    lo = _value_at_rank(F.floor(p) + 1, value_col).cast("double")
    hi = _value_at_rank(F.ceil(p) + 1, value_col).cast("double")
    if interpolation == "lower":
        return lo
    if interpolation == "higher":
        return hi
    if interpolation == "midpoint":
        return (lo + hi) / 2
    if interpolation == "linear":
        frac = F.max(p - F.floor(p))          # constant within a group
        return lo + frac * (hi - lo)
    raise ValueError(f"interpolation must be one of {INTERPOLATIONS}")


def nearest_quantiles(df: DataFrame, group_col: str, value_col: str,
                      quantiles=(0.1, 0.9), names=DISTRIBUTION_COLUMNS[3:],
                      interpolation: str = "nearest") -> DataFrame:
    """Exact quantiles per group (AG5), by default with nearest-rank
    interpolation: the value of rank round((n-1)·q)+1 among the group's n
    non-NULL values, read off the value histogram (see ``_histogram``)."""
    hist = _histogram(df, group_col, value_col)
    return hist.groupBy(group_col).agg(
        *[_quantile(q, value_col, interpolation).alias(n) for q, n in zip(quantiles, names)])


def distribution_panel(df: DataFrame, group_col: str, value_col: str,
                       std_digits: int | None = None, interpolation: str = "nearest",
                       count_col: str | None = None) -> DataFrame:
    """Mean (1 decimal), exact median, sample std and 10th/90th percentile
    per group (AG1-AG5), sorted by group with NULL first (ST1). Percentiles
    use ``interpolation`` (default nearest rank, see ``_quantile``).

    One pass over the input: everything is derived from the value
    histogram. Sums are exact decimals, so the mean and the sample
    variance (S2 - S1²/n) / (n - 1) do not depend on summation order; the
    median is the midpoint of the values at ranks floor((n+1)/2) and
    ceil((n+1)/2).
    """
    mean, median, std_dev, low, high = DISTRIBUTION_COLUMNS
    hist = _histogram(df, group_col, value_col, count_col)
    dec = T.DecimalType(38, 0)
    v = F.col(value_col).cast(T.DecimalType(20, 0))
    c = F.col("_nn").cast(T.DecimalType(20, 0))
    stats = hist.groupBy(group_col).agg(
        F.sum("_nn").alias("_N"),
        F.sum((v * c).cast(dec)).alias("_S1"),
        F.sum((v * v * c).cast(dec)).alias("_S2"),
        _value_at_rank(F.floor((F.col("_n") + 1) / 2), value_col).alias("_lo"),
        _value_at_rank(F.ceil((F.col("_n") + 1) / 2), value_col).alias("_hi"),
        _quantile(0.1, value_col, interpolation).alias(low),
        _quantile(0.9, value_col, interpolation).alias(high))
    n, s1, s2 = F.col("_N"), F.col("_S1"), F.col("_S2")
    var = F.when(n > 1, ((s2 - s1 * s1 / n) / (n - 1)).cast("double"))
    std = F.when(var.isNotNull(), F.sqrt(F.greatest(var, F.lit(0.0))))
    if std_digits is not None:
        std = F.round(std, std_digits)
    return (stats.select(
        group_col,
        F.round(F.when(n > 0, s1.cast("double") / n), 1).alias(mean),
        ((F.col("_lo") + F.col("_hi")) / 2).cast("double").alias(median),
        std.alias(std_dev), low, high)
        .orderBy(F.col(group_col).asc_nulls_first()))


def availability_panel(df: DataFrame, group_col: str, value_col: str, count_col: str | None = None) -> DataFrame:
    """Rows, late (> 0) and available (<= 0) counts and their percentages
    per group (AG6-AG8). N counts rows with a NULL lag too."""
    rows, late_n, late_pct, avail_n, avail_pct = AVAILABILITY_COLUMNS
    v = F.col(value_col)
    w, none = _weight(count_col), F.lit(0).cast("bigint")
    n = F.sum(w)
    late = F.sum(F.when(v > 0, w).otherwise(none))
    avail = F.sum(F.when(v <= 0, w).otherwise(none))
    return (df.groupBy(group_col).agg(
        n.alias(rows), late.alias(late_n), F.round(late / n * 100, 1).alias(late_pct),
        avail.alias(avail_n), F.round(avail / n * 100, 1).alias(avail_pct))
        .orderBy(F.col(group_col).asc_nulls_first()))


def sign_counts(df: DataFrame, value_col: str, count_col: str | None = None) -> DataFrame:
    """Counts on-or-before and after in one pass (AG10)."""
    v, w, none = F.col(value_col), _weight(count_col), F.lit(0).cast("bigint")
    return df.agg(F.coalesce(F.sum(F.when(v <= 0, w)), none).alias("n_on_or_before_ff92"),
                  F.coalesce(F.sum(F.when(v > 0, w)), none).alias("n_after_ff92"))
