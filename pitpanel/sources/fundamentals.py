"""Pipe-delimited fundamentals files (SC5, SC6).

The file kind is the run of letters after ``WS`` at the start of the file
name; files are grouped by kind on the driver (names only) and each kind is
read once with its declared all-string schema. Unknown kinds are read with
their first line as header. ``ord`` keeps file order for "first value"
rules: (file name, split start, position in split).

A quoted field may hold line breaks (free-text notes). Files in which a line ends inside a quoted field are found by a
scan of the text and read whole, one task a file, so that no split cuts a record; all other files
are read in splits. A row whose number of fields is not the layout's is kept (missing fields NULL, further ones left
out) with its text in ``BAD``, so that it can be counted and looked at.
"""

from __future__ import annotations

import re
import warnings
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitpanel.functions import parse_date
from pitpanel.functions.numeric import whole_number
from pitpanel.schemas import FUNDAMENTALS_LAYOUT, fundamentals_schema
from pitpanel.sources._charset import ensure_charset
from pitpanel.sources._fs import list_files, plain_name

_KIND = re.compile(r"^(WS[A-Za-z]+)")

BAD = "bad_line"

# A line that ends inside a quoted field: whole fields, then a field whose closing quote is missing. A quote opens a
# field only as its first character; doubled quotes belong to the text.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
OPEN_AT_END = rf'^(?:(?:{_QUOTED}"[^|]*+|[^"|][^|]*+|)\|)*+{_QUOTED}$'


def kind_of(file_name: str) -> str | None:
    m = _KIND.match(file_name.rsplit("/", 1)[-1])
    return m.group(1) if m else None


def group_by_kind(paths) -> dict:
    """{kind: [paths]}; files whose name does not start with a kind are
    skipped with a warning (they are not fundamentals files)."""
    out, other = defaultdict(list), []
    for p in paths:
        k = kind_of(p)
        (out[k] if k else other).append(p)
    if other:
        warnings.warn(f"skipped {len(other)} file(s) without a kind prefix, e.g. {other[0]}")
    return dict(out)


def _with_order(df: DataFrame) -> DataFrame:
    return df.withColumn("ord", F.struct(F.col("_metadata.file_name").alias("f"),
                                         F.col("_metadata.file_block_start").alias("b"),
                                         F.monotonically_increasing_id().alias("i")))


def files_with_line_breaks(spark: SparkSession, paths, encoding: str = "windows-1252") -> list:
    """The files that hold a line ending inside a quoted field (their names reach the driver, no data)."""
    lines = spark.read.option("encoding", ensure_charset(spark, encoding)).text(list(paths))
    rows = (lines.where(F.col("value").contains('"')).where(F.col("value").rlike(OPEN_AT_END))
            .select(F.col("_metadata.file_path").alias("f")).distinct().collect())
    return [r.f for r in rows]


def read_kind(spark: SparkSession, paths, kind: str, encoding: str = "windows-1252",
              typed: bool = True, bad: bool = False) -> DataFrame:
    """All files of one kind: one read for those that can be split, one for those with line breaks in
    a quoted field. With ``bad`` a further column ``BAD`` holds the text of rows with too few or too many fields."""
    encoding = ensure_charset(spark, encoding)
    paths = list(paths)

    def read(files, multi_line):
        # a quote inside a quoted field is a doubled quote
        r = (spark.read.option("sep", "|").option("encoding", encoding).option("mode", "PERMISSIVE")
             .option("multiLine", str(multi_line).lower()).option("escape", '"'))
        if kind not in FUNDAMENTALS_LAYOUT:
            return r.option("header", "true").csv(files)
        schema = fundamentals_schema(kind)
        if bad:
            schema = T.StructType(schema.fields + [T.StructField(BAD, T.StringType())])
            r = r.option("columnNameOfCorruptRecord", BAD)
        return r.schema(schema).option("header", "false").csv(files)

    whole = set(files_with_line_breaks(spark, paths, encoding)) if kind in FUNDAMENTALS_LAYOUT else set()
    # the scan names files by URI; compare the decoded forms
    whole = {_decoded(f) for f in whole}
    parts = [(False, [p for p in paths if _decoded(p) not in whole]), (True, [p for p in paths if _decoded(p) in whole])]
    frames = [_with_order(read(files, multi)) for multi, files in parts if files]
    df = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    if typed:
        df = type_fundamentals(df)
    return df


def _decoded(path: str) -> str:
    """A path for comparison: no scheme, %-escapes of URIs resolved."""
    from urllib.parse import unquote
    return re.sub(r"^[a-z0-9]+:/+", "/", unquote(path) if "://" in path else path)


def type_fundamentals(df: DataFrame) -> DataFrame:
    """Cast at use: codes and periods to bigint, dates to date (lenient:
    bad text -> NULL); ``value`` stays text (it may carry quotes/markers)."""
    casts = {}
    for c in ("item_code", "fiscal_period"):
        if c in df.columns:
            casts[c] = whole_number(c)
    if "point_date" in df.columns:
        casts["point_date"] = parse_date("point_date", "yyyyMMdd", strict=False)
    return df.withColumns(casts)


def fundamentals_files(spark: SparkSession, root: str, kinds=None) -> dict:
    """{kind: [paths]} of the ``*.txt`` below ``root`` that are not empty."""
    groups = group_by_kind(p for p, size in list_files(spark, root)
                           if size > 0 and p.lower().endswith(".txt"))
    return groups if kinds is None else {k: v for k, v in groups.items() if k in set(kinds)}


def read_fundamentals(spark: SparkSession, root: str, kinds=None,
                      encoding: str = "windows-1252", bad: bool = False) -> dict:
    """{kind: DataFrame} for every kind of ``*.txt`` found below ``root`` (or only ``kinds``)."""
    return {k: read_kind(spark, v, k, encoding, bad=bad) for k, v in fundamentals_files(spark, root, kinds).items()}


def write_fundamentals_store(spark: SparkSession, root: str, out: str, kinds=None,
                             encoding: str = "windows-1252") -> dict:
    """Every kind parsed once and written typed, with file order and ``BAD``, below ``out``; {kind: the
    table read again}. Later steps read the columns they need instead of parsing the text once per use."""
    frames = {}
    for kind, df in read_fundamentals(spark, root, kinds, encoding, bad=True).items():
        if BAD not in df.columns:
            df = df.withColumn(BAD, F.lit(None).cast("string"))
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/{kind}")
        frames[kind] = spark.read.schema(df.schema).parquet(f"{out}/{kind}")
    return frames


def fundamentals_report(store: dict) -> DataFrame | None:
    """SK7: (file, kind, status, rows, bad_rows) per loaded file, from the small columns of the store."""
    parts = [df.groupBy(plain_name("ord.f").alias("file")).agg(F.count(F.lit(1)).alias("rows"), F.count(BAD).alias("bad_rows"))
             .select("file", F.lit(kind).alias("kind"), F.lit("loaded").alias("status"), "rows", "bad_rows")
             for kind, df in store.items()]
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out
