"""The training-data pipeline: quality rules, near duplicates, benchmark decontamination, mixing,
token files. Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared folder and reads it again as the next stage's docs. All but the last stage
return the columns of ``documents``; the last returns one row per written document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import decontaminate, mixing, near_dups, quality, token_files
from pitpanel.llm.base import table, without_ids
from pitpanel.llm.queries import tokenizer_path
from pitpanel.session import work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A doc_id (NULL is one) with several rows stays if all are kept; a NULL
    or empty text goes; without labels the base rules alone decide; an empty table stays empty; other columns are kept."""
    return without_ids(docs, quality.judge(docs, table(spark, sf_dir, "labels")).where(~F.col("kept")).select("doc_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id (NULL last). Texts without a word are
    in a group with equal texts only; of rows that repeat a doc_id and a text one stays."""
    return near_dups.representatives(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item's tiles cover. A doc_id (NULL is one) with several rows stays if none is covered;
    NULL and empty texts stay; an empty benchmark removes nothing."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask for; the unwanted domains' targets are upper limits, so that
    no scarce text is repeated in order to fill them. Repeated rows are separate documents; a NULL or empty
    text keeps the rate of its posteriors; without labels every document stays once."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), ceilings=mixing.CEILINGS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, and per document written: doc_id, start, n_tokens, ids_crc32. A NULL or empty text is the
    end id alone; NULL doc_ids come first; an empty table writes an empty table."""
    path = work_dir(spark, "pipeline-tokens")
    token_files.write(docs, path, tokenizer_path())
    return token_files.digest(token_files.read(spark, path))


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", benchmark_free),
          ("mixing", mixed), ("token files", token_output)]

#: Tilings, fitted rates and tokenizer ids have no SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
