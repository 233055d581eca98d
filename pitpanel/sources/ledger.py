"""Ledger of loaded input files (SK6 per input): a rerun reads only what is new.

A ledger row says which batch loaded a file of which size and modification time. A file counts as new when
no row has its path, size and time, so a file delivered again is loaded again; the rows it gave before are
those of an older batch and are left out by ``current``. The ledger is a small Parquet folder to which
each batch appends one part; it is written after the batch's data, so a batch that failed half-way
is loaded again into its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.sources._fs import list_files

SCHEMA = "file string, size bigint, modified timestamp, batch int"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    files = [p for p, size in list_files(spark, path) if size > 0 and p.endswith(".parquet")]
    return spark.read.schema(SCHEMA).parquet(path) if files else spark.createDataFrame([], SCHEMA)


def unseen(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows of ``manifest`` (file, size, modified, ...) whose file the ledger does not hold in this state."""
    return manifest.join(ledger.select("file", "size", "modified"), ["file", "size", "modified"], "left_anti")


def next_batch(ledger: DataFrame) -> int:
    return (ledger.agg(F.max("batch")).first()[0] or 0) + 1


def record(files: DataFrame, path: str, batch: int) -> None:
    (files.select("file", "size", "modified", F.lit(batch).cast("int").alias("batch"))
     .coalesce(1).write.mode("append").parquet(path))


def current(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows (with file and batch) of the batch that loaded each file last."""
    last = ledger.groupBy("file").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["file", "batch"], "left_semi")
