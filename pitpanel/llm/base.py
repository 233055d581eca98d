"""What the operators of this subpackage share: reading a given table, cutting
lineage with a table written to the cluster's shared folder, and normalising an
input frame to the columns an operator needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.session import work_dir
from pitpanel.sources._fs import remove


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again, so that later
    jobs neither repeat its work nor lose it with an executor. ``codec``: of the files, else the session's."""
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{name}")
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes ``staged`` tables that nothing reads any more (what was made from them is staged itself)."""
    for t in tables:
        remove(t.sparkSession, t.staged_path)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id bigint, text string, *more): a NULL text is the empty text; every other
    column of the input is left out, so extra columns cannot clash."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def unused(df: DataFrame, *stems: str) -> list:
    """Column names beginning with ``stems`` that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without_ids(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id (NULL equals NULL) is not in the one column of ``bad``."""
    (name,) = unused(docs, "_bad_id")
    bad = bad.toDF(name).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
