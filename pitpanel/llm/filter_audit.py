"""Filter interaction audit by the Hart-Mas-Colell potential.

The filters of a corpus play a removal game: a coalition S of filters is worth v(S), the documents that at
least one filter of S fails. All that the audit tells follows from v alone, so the corpus is reduced to one
count for each (part, set of failed filters) and every part to its 2**k coalition values:

* a step of an order that has applied S and now applies i removes v(S + i) - v(S);
* the potential of S is P(S) = (v(S) + sum of P(S - i) over i in S) / |S|, P of nothing 0, and filter i's Shapley
  value is P(all) - P(all - i). ``potentials`` keeps |S|! P(S), which are whole numbers, and the reported
  value is summed over all k! orders (k! times the Shapley value): exact in 64 bits.

The values of good and of toxic documents are games of their own over the same failed sets.

Filters read whole texts (NULL: empty) inside tasks; words are runs of anything but ASCII white space:
A under 200 words; B fewer distinct words than half of all; C more than 2 % of the code points in A-Z; D one of
``#$%&*|``; E equal to the text of a smaller doc_id anywhere in the table, removed or not.

Defined cases: a NULL or empty text fails A (and E if a smaller doc_id has one, too) and nothing else; rows that
repeat a doc_id are counted one by one, and fail E only if a smaller doc_id has their text; a NULL doc_id is not
smaller than any and has no smaller one; a NULL source is the part ''; a document without a label
is neither good nor toxic, one with several is what any of them says; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.base import staged, texts

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 2
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = re.compile(rb"[#$%&*|]")


def failed(text: bytes) -> int:
    """Bits of the filters A to D that a UTF-8 text fails (A is the lowest bit)."""
    words = text.split()                 # of bytes: at space, tab, \n, \v, \f, \r
    upper, points = len(text.translate(None, _NOT_UPPER)), len(text.translate(None, _CONTINUATION))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * upper > UPPER_PERCENT * points) << 2 | (_SYMBOLS.search(text) is not None) << 3)


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, content, mask): the text's SHA-256 and the failed ones of A to D, without the texts."""
    def run(batches):
        for b in batches:
            raw = b.column("text").cast(pa.binary())
            mask, content = [], []
            for x in raw:
                t = x.as_py()
                mask.append(failed(t))
                content.append(hashlib.sha256(t).digest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), pa.array(content, pa.binary()), pa.array(mask, pa.int32())],
                ["doc_id", "part", "content", "mask"])

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    return texts(docs, part).mapInArrow(run, "doc_id bigint, part string, content binary, mask int")


def with_copies(rows: DataFrame, bit: int = 1 << 4) -> DataFrame:
    """Sets ``bit`` where a smaller doc_id has the same content. The least id of each content is
    joined on (content, doc_id), so a content with many copies is no hot join key."""
    first = (rows.where("doc_id IS NOT NULL").groupBy("content").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("is_first", F.lit(True)))
    copy = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    return (rows.join(first, ["content", "doc_id"], "left")
            .withColumn("mask", F.when(copy, F.col("mask").bitwiseOR(F.lit(bit))).otherwise(F.col("mask"))).drop("is_first"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good and toxic (0 or 1)."""
    per = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
           .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    return rows.join(per, "doc_id", "left").fillna(0, ["good", "toxic"])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, good ones and toxic ones per part and set of failed filters."""
    rows = with_labels(with_copies(staged(judged(docs), "audit-judged")), labels)
    return rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").cast("bigint").alias("good"),
                                            F.sum("toxic").cast("bigint").alias("toxic"))


def coalition_values(cells: DataFrame, k: int, measures=("n", "good", "toxic")) -> DataFrame:
    """One row per part: for each measure an array of v(S), S from 0 to 2**k - 1 read as bits."""
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    per = (cells.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 1))))
           .groupBy("part", "coalition").agg(F.sum("n").alias("total"), *[
               F.sum(F.when(hit, F.col(x)).otherwise(F.lit(0).cast("bigint"))).alias(x) for x in measures]))
    rows = F.sort_array(F.collect_list(F.struct("coalition", *measures)))            # 2**k of them
    return per.groupBy("part", "total").agg(rows.alias("v")).select(
        "part", "total", *[F.col(f"v.{x}").alias(x) for x in measures])


def potentials(v: Column, k: int) -> Column:
    """Array of |S|! P(S): |S|! P(S) = (|S| - 1)! v(S) + sum of |S - i|! P(S - i). Coalitions come in the order of
    their bits, so every S - i is there before S."""
    factorials = F.array(*[F.lit(math.factorial(i)).cast("bigint") for i in range(k)])

    def add(done, s):
        below = [F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(done, s.bitwiseXOR(F.lit(1 << i))))
                 .otherwise(F.lit(0).cast("bigint")) for i in range(k)]
        own = F.get(factorials, F.bit_count(s) - 1) * F.get(v, s)
        return F.concat(done, F.array(sum(below, own)))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << k) - 1)), F.array(F.lit(0).cast("bigint")), add)


def audit(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step. ``cells``: (part, mask, n, good, toxic), bit i of the mask
    being the i-th letter of ``names``; all k! orders are listed, so keep to a handful of filters."""
    k, everything = len(names), (1 << len(names)) - 1
    if not 1 <= k <= 7:
        raise ValueError("an audit lists all orders: use 1 to 7 filters")
    parts = coalition_values(cells, k).withColumn("potential", potentials(F.col("n"), k))
    orders = F.array(*[F.lit("".join(o)) for o in itertools.permutations(names)])
    rows = (parts.withColumn("filter_order", F.explode(orders))
            .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k)))))

    def bit(letter):
        return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(names), letter) - 1)

    applied = F.aggregate(F.sequence(F.lit(1), F.col("step")), F.lit(0),
                          lambda s, i: s.bitwiseOR(bit(F.substring(F.col("filter_order"), i, F.lit(1)))))
    rows = (rows.withColumn("own", bit(F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))).withColumn("after", applied)
            .withColumn("before", F.col("after").bitwiseXOR(F.col("own"))))
    rest = F.lit(everything).bitwiseXOR(F.col("own"))

    def gain(measure):
        return F.get(F.col(measure), F.col("after")) - F.get(F.col(measure), F.col("before"))

    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.get("n", F.col("after"))).alias("kept"),
        gain("n").alias("removed"), (F.get("n", F.col("own")) - gain("n")).alias("redundant"),
        (F.get("n", F.lit(everything)) - F.get("n", rest)).alias("unique_fails"),
        gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(everything)) - F.lit(k) * F.get("potential", rest)).alias("shapley"))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over a corpus, per source."""
    return audit(failures(docs, labels), FILTERS)
