"""Column profiling (AG11-AG15).

NULL counts, distinct counts and frequent values of any number of columns come from one
histogram: the columns are unpivoted to (column, value) and counted, combined map-side. The input is
read once and what is shuffled is one row per task, column and distinct value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_histogram(df: DataFrame, cols=None) -> DataFrame:
    """(column_name, value, n): rows per column and value; values as text, NULL is a value. Every
    column has a NULL row (n 0 if it has no NULL), so that columns of an empty table appear too."""
    cols = list(cols) if cols is not None else df.columns
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols])
    none = df.sparkSession.createDataFrame([(c, None, 0) for c in cols], "column_name string, value string, n bigint")
    return (df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
            .unionByName(none).groupBy("column_name", "value").agg(F.sum("n").alias("n")))


def histogram_profile(hist: DataFrame) -> DataFrame:
    """NULL count and distinct non-NULL count per column (AG13, AG14)."""
    return hist.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(F.lit(0).cast("bigint"))).alias("null_count"),
        F.count("value").alias("unique_count"))


def histogram_top(hist: DataFrame, k: int = 10) -> DataFrame:
    """(column_name, value, frequency): the k most frequent values of each column (AG11), NULL being a value;
    ties by value, NULL first. Each task keeps k rows a column before the shuffle."""
    best = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value").asc_nulls_first())
    return (hist.where("n > 0").withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
            .select("column_name", "value", F.col("n").alias("frequency")))


def column_profile(df: DataFrame, cols=None, approx: bool = False) -> DataFrame:
    """NULL count and distinct non-NULL count of each column (AG13, AG14), one output row per column:
    exact from the columns' histogram, or by sketches with ``approx``; one pass either way."""
    cols = list(cols) if cols is not None else df.columns
    if not approx:
        return histogram_profile(value_histogram(df, cols))
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
                    *[F.approx_count_distinct(f"`{c}`").alias(f"d{i}") for i, c in enumerate(cols)])
    return reduce(DataFrame.unionByName, [counts.select(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"),
                                                        F.col(f"d{i}").alias("unique_count")) for i, c in enumerate(cols)])


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent values of one column, in its own type (AG11); NULL is a value. Ties by value."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("frequency"))
            .orderBy(F.col("frequency").desc(), F.col(col).asc_nulls_first())
            .limit(k))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per non-NULL value (AG12)."""
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias("counts")))


def shape(df: DataFrame) -> dict:
    """Row count, column names and types (AG15); only the count runs a job."""
    return {"rows": df.count(), "columns": df.columns, "dtypes": df.dtypes}


def shape_row(df: DataFrame) -> DataFrame:
    """Row and column count of a table as one row (AG15)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
