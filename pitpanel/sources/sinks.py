"""Writers (SK1-SK7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  compression: str = "zstd") -> None:
    """Parquet sink (SK1). ``mode="ignore"`` skips an existing output (SK6)."""
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_panel_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with header for result panels (SK2). Panels have one row per
    bin, so a single output file is fine; only its write is one task."""
    df.repartition(1).write.mode(mode).option("header", "true").csv(path)


def head_rows(df: DataFrame, n: int, order_cols=None) -> DataFrame:
    """First ``n`` rows in a deterministic order (LM1): a top-n, each task keeps
    at most n rows. Without ``order_cols`` every column orders."""
    cols = list(order_cols) if order_cols else df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)


def export_head(df: DataFrame, path: str, n: int = 10_000, order_cols=None) -> None:
    """First ``n`` rows to CSV (SK3)."""
    write_panel_csv(head_rows(df, n, order_cols), path)


def write_by_item(df: DataFrame, path: str, item_col: str = "item_code",
                  mode: str = "overwrite") -> None:
    """One folder per item, NULL item rows not written (SK4).

    ``rebalance`` clusters rows by item so each item lands in few files,
    while AQE splits an item that holds a large share of the rows over
    several tasks and merges small ones; readers prune on ``item_col``.
    """
    (df.where(F.col(item_col).isNotNull())
     .hint("rebalance", item_col)
     .write.mode(mode).option("compression", "zstd")
     .partitionBy(item_col).parquet(path))


def append_frames(frames, path: str, mode: str = "overwrite") -> None:
    """Many inputs into one dataset (SK5): union by name, one write."""
    from functools import reduce
    reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) \
        .write.mode(mode).option("compression", "zstd").parquet(path)


def with_row_count(df: DataFrame, name: str = "rows"):
    """Attach a row-count metric filled by the next action (SK7), no extra job.
    Returns ``(df, observation)``; read ``observation.get`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


REPORT = "job string, source string, status string, rows bigint, bad_rows bigint"


def append_report(rows: DataFrame, path: str | None) -> None:
    """SK7: appends ``REPORT`` rows - one per input file of a load, one per output of the other jobs."""
    if path:
        rows.select("job", "source", "status", F.col("rows").cast("bigint").alias("rows"),
                    F.col("bad_rows").cast("bigint").alias("bad_rows")).coalesce(1).write.mode("append").parquet(path)
