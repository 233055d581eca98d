"""Fiscal-year bins (SF11) and the lookup table joined in JN6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.schemas import OTHER_BIN, YEAR_BIN_RANGE, YEAR_BINS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_bin(c) -> Column:
    """Bin label for a year; NULL outside the lookup's year range or for NULL."""
    y = _c(c)
    lo, hi = YEAR_BIN_RANGE
    expr = F.when((y < lo) | (y > hi), F.lit(None).cast("string"))
    for first, last, label in YEAR_BINS:
        expr = expr.when(y.between(first, last), F.lit(label))
    return expr.when(y.isNotNull(), F.lit(OTHER_BIN))


def year_bins_frame(spark: SparkSession) -> DataFrame:
    """The year -> bin lookup (one row per year of the range, 60 rows).

    Built by a rule on ``spark.range``; its size is fixed by the range, so
    broadcasting it is always safe.
    """
    lo, hi = YEAR_BIN_RANGE
    return (spark.range(lo, hi + 1)
            .select(F.col("id").cast("int").alias("fye_year"))
            .withColumn("fye_bin", year_bin("fye_year")))
