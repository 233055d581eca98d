"""Matching files (SC7) and parquet folders (SC10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.sources._charset import ensure_charset


def read_matching_csv(spark: SparkSession, folder: str, encoding: str = "windows-1252",
                      schema=None) -> DataFrame:
    """All ``*.csv`` of a folder (not recursive) with header; every column is
    text (no inference). Zero-byte files yield no rows and no error."""
    r = (spark.read.option("header", "true").option("encoding", ensure_charset(spark, encoding))
         .option("pathGlobFilter", "*.csv").option("inferSchema", "false"))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(folder)


def read_parquet_folder(spark: SparkSession, folder: str, skip_unreadable: bool = False) -> DataFrame:
    """Every parquet file of a folder as one frame, columns unioned by name
    (missing -> NULL). An unreadable file fails the read unless ``skip_unreadable``."""
    return (spark.read.option("mergeSchema", "true")
            .option("ignoreCorruptFiles", str(skip_unreadable).lower()).parquet(folder))


def parquet_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, rows): every ``*.parquet`` of a folder with its rows, NULL where a task could not read it. The
    listing and the footers are read, no column."""
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
              .select(F.col("_metadata.file_path").alias("file")))
    found = (spark.read.schema("_probe int").option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.parquet").parquet(folder)
             .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows")))
    return listed.join(found, "file", "left")


def quarantine(spark: SparkSession, folder: str) -> tuple:
    """(good, bad): the rows of every readable file, columns unioned by name, and the (file) list of those that
    could not be read or hold no row."""
    bad = parquet_files(spark, folder).where("rows IS NULL").select("file")
    return read_parquet_folder(spark, folder, skip_unreadable=True), bad
