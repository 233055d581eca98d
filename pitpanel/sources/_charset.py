"""Vendor files are windows-1252; Spark 4 accepts that charset name only
with ``spark.sql.legacy.javaCharsets`` on (ISO-8859-1 differs in 0x80-0x9F)."""

from __future__ import annotations

from pyspark.sql import SparkSession

_STANDARD = {"utf-8", "utf8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32"}


def ensure_charset(spark: SparkSession, encoding: str) -> str:
    if encoding.lower() not in _STANDARD and \
            spark.conf.get("spark.sql.legacy.javaCharsets", "false").lower() != "true":
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return encoding
