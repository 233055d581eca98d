"""Vendor-shaped files written from the driver's tables, for the file
sources. Spark writes the lines (one task per output file); part files are
then renamed to vendor names on the file system — a metadata operation,
no data passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.plans import fixtures as fx
from pitpanel.sources._charset import ensure_charset


def _rename_parts(spark: SparkSession, staging: str, target_dir: str, stem: str, ext: str) -> list:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(staging)
    fs = src.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(target_dir))
    parts = sorted(st.getPath().toString() for st in fs.listStatus(src)
                   if st.getPath().getName().startswith("part-"))
    out = []
    for i, p in enumerate(parts):
        dst = f"{target_dir}/{stem}.{ext}" if len(parts) == 1 else f"{target_dir}/{stem}_{i:05d}.{ext}"
        fs.rename(jvm.org.apache.hadoop.fs.Path(p), jvm.org.apache.hadoop.fs.Path(dst))
        out.append(dst)
    fs.delete(src, True)
    return out


def write_lines(spark: SparkSession, lines: DataFrame, target_dir: str, stem: str,
                ext: str = "txt", encoding: str | None = None) -> list:
    """Write a one-column frame ``line`` (already ordered) as text files named
    ``<stem>_<n>.<ext>`` in ``target_dir``."""
    staging = f"{target_dir}/_staging_{stem}"
    w = lines.write.mode("overwrite")
    if encoding:
        w = w.option("encoding", ensure_charset(spark, encoding))
    w.text(staging)
    return _rename_parts(spark, staging, target_dir, stem, ext)


def _pipe_line(df: DataFrame, cols) -> DataFrame:
    parts = []
    for c in cols:
        if c == "point_date":
            parts.append(F.date_format("point_date", "yyyyMMdd"))
        else:
            parts.append(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return df.select(F.concat_ws("|", *parts).alias("line"))


SIX = ["ws_id", "point_date", "freq", "fiscal_period", "item_code", "value"]


def write_fundamentals_files(spark: SparkSession, t: fx.Tables, root: str, kinds=None, facts_kind: str = "WSFV") -> None:
    """Facts (named ``facts_kind``), WSCalendarPrd and WSReportedPrd pipe files, rows in
    ``ord`` order across files so file order reproduces the fixture order. The periods are dealt over
    ranges of ``ord`` before their rows are made, so one row per period is shuffled and sampled."""
    in_ranges = fx.period(t).repartitionByRange("ord")
    all_kinds = [(facts_kind, lambda: fx.facts(t).repartitionByRange("ord", "item_code", "value"), SIX),
                 ("WSCalendarPrd", lambda: fx.calendar_rows(in_ranges), SIX),
                 ("WSReportedPrd", lambda: fx.reported_rows(in_ranges), ["ws_id", "point_date", "freq", "item_code", "value"])]
    for kind, make, cols in all_kinds:
        if kinds is not None and kind not in kinds:
            continue
        ordered = make().sortWithinPartitions("ord", "item_code", "value")
        write_lines(spark, _pipe_line(ordered, cols), root, kind, "txt", "windows-1252")


def write_note_files(spark: SparkSession, t: fx.Tables, root: str) -> None:
    """Footnotes of every fact: each seventh period's note is quoted and holds a line break, a separator and
    doubled quotes; each eleventh has an inch mark; every 101st row has a field too many, every 103rd none for the note."""
    o = F.col("ord")
    item = F.col("item_code").cast("string")
    note = (F.when(o % 7 == 0, F.concat(F.lit('"See item '), item, F.lit(',\nrestated | ""twice"""')))
            .when(o % 11 == 0, F.concat(F.lit('about 6" wide, '), item)).otherwise(F.concat(F.lit("plain "), item)))
    extra = F.when(o % 101 == 0, "|extra").otherwise("")
    keys = F.concat_ws("|", "ws_id", F.date_format("point_date", "yyyyMMdd"), "freq", F.col("fiscal_period").cast("string"), item)
    line = F.when(o % 103 == 0, keys).otherwise(F.concat(keys, F.lit("|"), note, extra))
    ordered = fx.facts(t).select("ord", "item_code", "value", line.alias("line")).orderBy("ord", "item_code", "value")
    write_lines(spark, ordered.select("line"), root, "WSFVFootnote", "txt", "windows-1252")


def _quoted(c) -> F.Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def write_wide_price_files(spark: SparkSession, t: fx.Tables, root: str) -> None:
    """Wide daily price CSVs in ``LC``/``USD`` folders named
    ``Daily{Returns|MV}{cur}_<suffix>_00000.csv`` plus one file under an
    ``Index Returns`` folder that must be skipped. Each file: a banner line with commas,
    header line (seven metadata columns, ``DATES`` second), one line per
    security with one cell per day; every fifth security's cells are quoted, the empty cells that end every eleventh
    security's line are left out, and the returns of suffix 0 close with a line without a code. One
    file has no header, one is empty. One write job for all files (partitioned by target file), then renames."""
    headers = fx.wide_headers(t)
    meta = ["Name", "DATES", "CURRENCY", "ISIN", "GEOG", "SECTOR", "Source"]
    legs = []
    uid = F.substring("DSCode", 2, 20).cast("bigint")
    for tag, frame, leg in (("Returns", fx.price_ri(t), "RI"), ("MV", fx.price_mv(t), "MV")):
        w = fx.wide_from_leg(frame, leg, headers)
        fname = F.concat(F.col("Currency"), F.lit("__Daily"), F.lit(tag), F.col("Currency"),
                         F.lit("_"), F.col("suffix").cast("string"))
        cells = F.transform(F.array(*[F.col(f"`{h}`") for h in headers]),
                            lambda c: F.when(c.isNull(), "").when(uid % 5 == 0, _quoted(c)).otherwise(c))
        line = F.concat_ws(",",
                           _quoted(F.concat(F.lit("Co, "), F.col("DSCode"))),   # comma inside quotes
                           _quoted(F.col("DSCode")), F.col("Currency"), F.lit(""), F.lit(""), F.lit(""),
                           F.lit("DS"), F.array_join(cells, ","))
        legs.append(w.select(fname.alias("fname"), F.lit(2).alias("k"), F.col("DSCode").alias("s"),
                             F.when(uid % 11 == 0, F.regexp_replace(line, ",+$", "")).otherwise(line).alias("line")))
    data = legs[0].unionByName(legs[1])
    files = data.select("fname").distinct()
    banner = files.select("fname", F.lit(0).alias("k"), F.lit("").alias("s"),
                          F.concat(F.lit("Daily export, all securities, "), F.col("fname")).alias("line"))
    header = files.select("fname", F.lit(1).alias("k"), F.lit("").alias("s"),
                          F.lit(",".join(meta + headers)).alias("line"))
    total = (files.where(F.col("fname").rlike("Returns[A-Z]+_0$"))
             .select("fname", F.lit(3).alias("k"), F.lit("").alias("s"), F.lit("Total").alias("line")))
    staging = f"{root}/_staging_wide"
    (banner.unionByName(header).unionByName(data).unionByName(total)
     .repartition("fname").sortWithinPartitions("fname", "k", "s")
     .select("fname", "line").write.mode("overwrite").partitionBy("fname").text(staging))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sp = jvm.org.apache.hadoop.fs.Path(staging)
    fs = sp.getFileSystem(conf)
    for st in fs.listStatus(sp):
        name = st.getPath().getName()
        if not name.startswith("fname="):
            continue
        folder, stem = name.split("=", 1)[1].split("__", 1)
        _rename_parts(spark, st.getPath().toString(), f"{root}/{folder}", stem, "csv")
    fs.delete(sp, True)
    # An index file, which the scan must skip; a file without a header; an empty file.
    idx = spark.createDataFrame([("x",), (",".join(meta + headers),),
                                 ('"Idx","IDX1",LC,,,,DS' + ",1" * len(headers),)], "line string")
    write_lines(spark, idx.coalesce(1), f"{root}/LC/Index Returns", "DailyReturnsLC_9", "csv")
    bad = spark.createDataFrame([("Daily export, all securities",), ("Co,U1,LC,,,,DS,1",)], "line string")
    write_lines(spark, bad.coalesce(1), f"{root}/LC", "DailyReturnsLC_8", "csv")
    write_empty(spark, f"{root}/USD/DailyReturnsUSD_7.csv")


def write_empty(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p).close()


def move(spark: SparkSession, source: str, target: str) -> None:
    """A delivery: a folder of files appears below a root."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(target).getParent())
    fs.rename(path(source), path(target))
