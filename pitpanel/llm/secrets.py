"""Secret scan over an incremental, content-addressed blob ledger.

A version of a path is addressed by the SHA-256 of its text. The ledger is a Parquet table
of (sha, rule version, spans); a scan reads the addresses of all versions, keeps those the
ledger lacks for the current rule version, runs the rules over one copy of each such blob,
appends the outcome (blobs without findings too) and joins it back to every path that ever
held the blob. A second scan of the same history therefore runs no rule at all, and changed
rules make a new rule version that rescans everything.

Spans are (kind, start, end) in code points, end exclusive, leftmost and non-overlapping per
kind, ordered by start, then kind as listed.

Defined cases: a NULL text is the empty blob; repeated rows and exact copies share one scan and
all get its findings; an empty input appends nothing.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm.base import texts
from pitpanel.sources._fs import list_files

# Fixed values: (kind, pattern, flags, group whose length counts, least length).
BASE_RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     re.IGNORECASE | re.ASCII, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", re.ASCII, 0, 18),
    ("hex", r"[0-9a-f]{16,}", re.ASCII, 0, 16),       # a run of 16+ is the run that [0-9a-f]+ finds
)
# Each is linear in the text: a run of characters is tried from its beginning only and never given back.
MORE_RULES = (
    # to the END line, or the header alone where the next line of dashes is not that
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----)?", re.ASCII, 0, 1),
    ("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", re.ASCII, 0, 1),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", re.ASCII, 0, 1),
    ("url", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]*+:[^\s:/@]++@", re.ASCII, 0, 1),
)
LEDGER = "sha binary, rule_version string, spans array<struct<kind:string,start:int,end:int>>"


def rule_version(rules) -> str:
    return hashlib.sha256(repr([(k, p, int(f), g, n) for k, p, f, g, n in rules]).encode()).hexdigest()[:16]


def find_spans(text: str, compiled: list) -> list:
    out = []
    for rank, (kind, pattern, group, least) in enumerate(compiled):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), rank, kind, m.end()))
    return [{"kind": k, "start": s, "end": e} for s, _, k, e in sorted(out)]


def ledger_rows(spark: SparkSession, ledger: str, version: str) -> DataFrame:
    """The ledger's rows of one rule version; an unwritten ledger has none."""
    if any(p.endswith(".parquet") for p, _ in list_files(spark, ledger)):
        rows = spark.read.schema(LEDGER).parquet(ledger)
    else:
        rows = spark.createDataFrame([], LEDGER)
    return rows.where(F.col("rule_version") == version).drop("rule_version")


def update(versions: DataFrame, ledger: str, rules=BASE_RULES + MORE_RULES) -> DataFrame:
    """Scan the blobs of ``versions`` (doc_id, text) that the ledger lacks; returns the ledger's
    rows (sha, spans) of this rule version. One scan writes to a ledger at a time."""
    spark, version = versions.sparkSession, rule_version(rules)
    blobs = texts(versions).select(F.unhex(F.sha2("text", 256)).alias("sha"), "text")
    # which addresses are new is found without the texts; then one copy of each new blob, combined before the shuffle
    new = blobs.select("sha").distinct().join(ledger_rows(spark, ledger, version).select("sha"), "sha", "left_anti")
    unseen = blobs.join(new, "sha", "left_semi").groupBy("sha").agg(F.first("text").alias("text"))

    def run(batches):
        compiled = [(k, re.compile(p, f), g, n) for k, p, f, g, n in rules]
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            spans = [find_spans(t, compiled) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("sha"), pa.array([version] * len(spans), pa.string()), pa.array(spans, kinds)],
                ["sha", "rule_version", "spans"])

    unseen.mapInArrow(run, LEDGER).write.mode("append").parquet(ledger)
    return ledger_rows(spark, ledger, version)


def scan(versions: DataFrame, ledger: str, rules=BASE_RULES + MORE_RULES) -> DataFrame:
    """(doc_id, sha, spans) per row of ``versions``, whether its blob was scanned now or earlier."""
    found = update(versions, ledger, rules).where(F.size("spans") > 0)
    paths = texts(versions).select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"))
    return paths.join(found, "sha", "left").select(
        "doc_id", "sha", F.coalesce("spans", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("spans"))


def digest(scanned: DataFrame, base=tuple(r[0] for r in BASE_RULES)) -> DataFrame:
    """The contract's columns from ``scan``'s spans."""
    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    of_base = F.filter("spans", lambda s: s["kind"].isin(*base))
    return scanned.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                          F.sha2(text_of(of_base), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))
