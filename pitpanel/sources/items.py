"""The item-partitioned fundamentals table (SC11)."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.sources._fs import list_dirs


def available_items(spark: SparkSession, items_dir: str, codes) -> list:
    """Codes among ``codes`` that have a partition; the rest are warned about.
    Only partition folder names are listed (no data is read)."""
    present = set()
    level = [items_dir.rstrip("/")]
    for _ in range(2):                       # item_code=… directly or below batch=…
        nxt = []
        for d in level:
            for name in list_dirs(spark, d):
                if name.startswith("item_code="):
                    v = name.split("=", 1)[1]
                    if v.lstrip("-").isdigit():
                        present.add(int(v))
                elif "=" in name:
                    nxt.append(f"{d}/{name}")
        level = nxt
    out = [int(c) for c in codes if int(c) in present]
    missing = sorted(set(int(c) for c in codes) - present)
    if missing:
        warnings.warn(f"missing item partitions, skipped: {missing}")
    return out


def read_items(spark: SparkSession, items_dir: str, codes) -> DataFrame:
    """Rows of the given items; the filter prunes partitions at planning time."""
    return (spark.read.parquet(items_dir)
            .where(F.col("item_code").isin([int(c) for c in codes]))
            .withColumn("item_code", F.col("item_code").cast("bigint")))
