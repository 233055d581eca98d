"""Token ids in ORC files: one row per document in ascending doc_id order.

Documents are range-partitioned and sorted, encoded whole, closed with an end id and written
as ORC: integer columns run-length encoded, a row index every ``ROW_STRIDE`` rows, Bloom
filters on doc_id. Stripes are read in parallel, and a look-up of a document skips files,
stripes and row groups by their statistics and Bloom filters. A row also carries its block (the
task that wrote it, in doc_id order) and its id offset inside the block, so a document's
place in the whole stream is the sum of the blocks before it plus its offset: a sum over one
number per block, not a running total over all documents.

Defined cases: a NULL or empty text has the end id alone; repeated doc_ids stay separate rows,
ordered by their text's hash (equal texts in any order, with equal results); NULL doc_ids come
first; an empty table writes an empty table.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitpanel.llm.base import texts
from pitpanel.llm.tokens import encoder, slices

END_ID = 2
ROW_STRIDE = 1000
SCHEMA = "doc_id bigint, block int, offset bigint, n_tokens bigint, ids array<int>"


def encoded(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``SCHEMA`` rows, in order within and across partitions."""
    tie = F.xxhash64("text")
    ordered = (texts(docs).repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie))

    def run(batches):
        enc, end, offset = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes(), 0
        block = TaskContext.get().partitionId()
        for b in batches:
            batch = b.column("text").to_pylist()
            for i, j in slices(batch):
                ids = [x + end for x in enc.encode(batch[i:j])]
                n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(np.full(j - i, block, np.int32)),
                     pa.array(offset + ends - n), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)),
                                              pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))],
                    ["doc_id", "block", "offset", "n_tokens", "ids"])
                offset += int(ends[-1])

    return ordered.mapInArrow(run, SCHEMA)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, mode: str = "overwrite") -> None:
    (encoded(docs, tokenizer, end_id).write.mode(mode)
     .option("orc.compress", "ZSTD").option("orc.row.index.stride", str(ROW_STRIDE))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01").orc(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; filters on doc_id reach the ORC indexes."""
    return spark.read.schema(SCHEMA).orc(path)


def with_start(rows: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before this one."""
    blocks = (rows.groupBy("block").agg(F.sum("n_tokens").alias("n"))
              .select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("before")))
    return rows.join(blocks, "block").withColumn("start", F.col("before") + F.col("offset")).drop("before")


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, block, offset, n_tokens, ids_crc32) from the ids read back."""
    def run(batches):
        for b in batches:
            ids = b.column("ids")
            offs = np.frombuffer(ids.buffers()[1], dtype=np.int32)[ids.offset:ids.offset + len(ids) + 1]
            raw = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("block"), b.column("offset"), pa.array(np.diff(offs).astype(np.int64)),
                 pa.array(crc, pa.int64())], ["doc_id", "block", "offset", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id bigint, block int, offset bigint, n_tokens bigint, ids_crc32 bigint")


def digest(rows: DataFrame) -> DataFrame:
    blocks = (rows.groupBy("block").agg(F.sum("n_tokens").alias("n"))
              .select("block", (F.sum("n").over(Window.orderBy("block")) - F.col("n")).alias("before")))
    return checksums(rows).join(blocks, "block").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
