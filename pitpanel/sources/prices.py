"""Wide daily price files (SC1-SC4, RS1 on files).

Layout: one banner line, one header line (seven metadata columns, one of
them ``DATES`` holding the security code, then one column per date headed
``dd/MM/yyyy…``), then one row per security. Files differ in width.

What a file is - leg, currency, the suffix that pairs it - is read off its name: the manifest
(``price_manifest``) lists the files without opening one. The text is scanned twice: a header pass
(Spark cannot limit a scan to the first split of each file) that writes one row per file, and a
data pass that splits each line, joins it with its file's parsed dates, explodes
``arrays_zip(dates, cells)`` and writes a typed long store, partitioned by leg and currency, which every later
step reads (``write_price_store``). No per-file job, no driver-side parsing, no schema inference.

A file's banner is its first line whatever it holds, its header the second line; a file whose second line has no
``DATES`` cell among the metadata columns is not loaded and is listed as such (``price_report``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.functions import header_date_text, lenient_double, parse_date
from pitpanel.schemas import (CURRENCY_TAGS, INDEX_FOLDER_MARK, LEG_TAG_PATTERN, MV_TAG,
                              PRICE_ID_COLUMN, PRICE_META_COLUMNS)
from pitpanel.session import work_dir
from pitpanel.sources import ledger
from pitpanel.sources._fs import list_status, plain_name, uri_path

STORE_SCHEMA = ("DSCode string, Date date, Value double, suffix string, file string, batch int, leg string, "
                "Currency string")


def _one_form(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _file_column() -> Column:
    return _one_form(plain_name("_metadata.file_path"))


def _kept(df: DataFrame, root: str) -> DataFrame:
    """Adds rel_path (what follows the root) and drops files of index folders (SC3)."""
    parent = F.element_at(F.split("file", "/"), -2)
    rel = F.coalesce(F.get(F.split("file", "\\Q" + uri_path(df.sparkSession, root) + "\\E", 2), F.lit(1)), "file")
    return df.where(~parent.contains(INDEX_FOLDER_MARK)).withColumn("rel_path", rel)


def _tags(df: DataFrame) -> DataFrame:
    """Leg, Currency and suffix from the file's name and path (SC4, JN2)."""
    stem = F.regexp_extract("file", r"([^/]*)\.csv$", 1)
    currency = F.lit("Unknown")
    for tag in reversed(CURRENCY_TAGS):                   # first tag found wins
        currency = F.when(F.col("rel_path").contains(tag), F.lit(tag)).otherwise(currency)
    return df.withColumns({"Currency": currency, "leg": F.when(stem.contains(MV_TAG), "MV").otherwise("RI"),
                           "suffix": F.regexp_replace(stem, LEG_TAG_PATTERN, "")})


def price_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(file, raw, size, modified, rel_path, Currency, leg, suffix), raw being the path to read: one row
    per ``*.csv`` below ``root`` (SC2-SC4), empty files too. Only the listing is read; names reach the driver."""
    root = root.rstrip("/")
    rows = [f for f in list_status(spark, root) if f[0].lower().endswith(".csv")]
    files = spark.createDataFrame(rows, "raw string, size bigint, ms bigint").select(
        _one_form(F.col("raw")).alias("file"), "raw", "size", F.timestamp_millis("ms").alias("modified"))
    return _tags(_kept(files, root))


def leg_pairs(manifest: DataFrame) -> DataFrame:
    """(suffix, Currency) that have both legs, from file names alone (JN2)."""
    return (manifest.groupBy("suffix", "Currency").agg(F.count_distinct("leg").alias("legs"))
            .where("legs = 2").select("suffix", "Currency"))


def _unquote(c: Column) -> Column:
    return F.trim(F.translate(c, '"', ""))


def read_price_lines(spark: SparkSession, root: str, files=None) -> DataFrame:
    """(file, rel_path, first_split, place, line) of the price files below ``root`` (of ``files`` only, if
    given); ``place`` ascends within a split."""
    root = root.rstrip("/")
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
             .text([root] if files is None else list(files))
             .select(_file_column().alias("file"), (F.col("_metadata.file_block_start") == 0).alias("first_split"),
                     F.monotonically_increasing_id().alias("place"), F.col("value").alias("line")))
    return _kept(lines, root)


def _cells(line: Column) -> Column:
    """A CSV line's cells; a quoted cell may hold commas."""
    return F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit('("(?:[^"]|"")*"[^",]*|[^,]*),'), F.lit(1))


def price_headers(spark: SparkSession, root: str, n_meta: int = PRICE_META_COLUMNS,
                  id_column: str = PRICE_ID_COLUMN, files=None) -> DataFrame:
    """(file, banner, header, cells): each file's first two lines and the header's cells, NULL where
    the second line is no header. One scan, written to the shared folder (one row per file)."""
    lines = read_price_lines(spark, root, files).where("first_split")
    # lines that may be headers are few: only they are cut into cells
    cells = F.transform(_cells(F.col("line")), _unquote)
    named = F.when(F.col("line").contains(id_column), F.when(
        F.array_contains(F.slice(cells, 1, n_meta), id_column), F.struct("place", F.col("line").alias("header"), cells.alias("cells"))))
    found = lines.groupBy("file").agg(F.min(F.struct("place", "line")).alias("first"), F.collect_list(named).alias("named"))
    second = F.get(F.filter("named", lambda h: h["place"] == F.col("first.place") + 1), F.lit(0))
    path = work_dir(spark, "price-headers")
    found.select("file", F.col("first.line").alias("banner"), second["header"].alias("header"),
                 second["cells"].alias("cells")).write.parquet(path)
    return spark.read.parquet(path)


def wide_prices_long(spark: SparkSession, root: str, n_meta: int = PRICE_META_COLUMNS, id_column: str = PRICE_ID_COLUMN,
                     strict_dates: bool = False, headers: DataFrame | None = None, files=None) -> DataFrame:
    """Long rows ``(DSCode, Date, Value, Currency, leg, suffix, file)`` of every
    wide price file; NULL cells are kept, non-numeric cells become NULL (PR5),
    non-date headers give a NULL date (SF1, SF5).

    Files of one export share their date columns, so dates are parsed once per distinct
    *layout*, not once per cell. Each data line joins a one-row-per-file map and its
    layout (broadcast by AQE when small; otherwise sort-merge joins whose
    skewed partitions AQE splits). A line with too few cells is padded with NULLs, one too short to
    hold a code has a NULL code. ``headers``: ``price_headers`` if there already.
    """
    headers = (price_headers(spark, root, n_meta, id_column, files) if headers is None else headers).where("cells IS NOT NULL")
    layout = F.sha2(F.array_join("cells", "\u001f", ""), 256).alias("layout")
    file_map = headers.select("file", "banner", "header", layout)
    layouts = (headers.groupBy(layout).agg(F.min("cells").alias("h"))
               .select("layout",
                       F.array_position(F.slice("h", 1, n_meta), id_column).cast("int").alias("id_pos"),
                       (F.size("h") - n_meta).alias("n_dates"),
                       F.transform(F.slice("h", n_meta + 1, 1 << 30),
                                   lambda x: parse_date(header_date_text(x), "dd/MM/yyyy", strict_dates))
                       .alias("hdates")))
    above = F.col("first_split") & ((F.col("line") == F.col("banner")) | (F.col("line") == F.col("header")))
    data = (read_price_lines(spark, root, files).join(file_map, "file").where(~above & (F.col("line") != "")).join(layouts, "layout")
            # exploded from an array of one, so that the optimizer does not cut the line again at each use
            .select("file", "rel_path", "id_pos", "n_dates", "hdates", F.explode(F.array(_cells(F.col("line")))).alias("c")))
    code = F.nullif(_unquote(F.get("c", F.col("id_pos") - 1)), F.lit(""))
    n = F.greatest(F.col("n_dates"), F.lit(0))
    given = F.slice("c", F.lit(n_meta + 1), F.greatest(F.least(F.size("c") - n_meta, n), F.lit(0)))
    values = F.concat(given, F.array_repeat(F.lit(None).cast("string"), n - F.size(given)))
    long = (data.select("file", "rel_path", code.alias("DSCode"),
                        F.arrays_zip(F.col("hdates").alias("d"), values.alias("v")).alias("z"))
            .select("file", "rel_path", "DSCode", F.inline("z")))
    return _tags(long).select("DSCode", F.col("d").alias("Date"), lenient_double(_unquote(F.col("v"))).alias("Value"),
                              "Currency", "leg", "suffix", "file")


def write_price_store(spark: SparkSession, root: str, path: str, headers: DataFrame | None = None, files=None) -> DataFrame:
    """The long rows written once, one folder per leg and currency, and read again."""
    long = wide_prices_long(spark, root, headers=headers, files=files)
    long.write.mode("overwrite").partitionBy("leg", "Currency").option("compression", "zstd").parquet(path)
    return spark.read.schema(long.schema).parquet(path)


def update_price_store(spark: SparkSession, root: str, store: str, ledger_path: str) -> int:
    """SK6 per input file: loads the files the ledger does not hold into a batch of their own and
    returns how many there were; files already loaded are not opened. Read the store with ``read_price_store``."""
    held = ledger.read_ledger(spark, ledger_path)
    new = ledger.unseen(price_manifest(spark, root), held)
    paths = [r.raw for r in new.select("raw").collect()]            # names only
    if not paths:
        return 0
    batch = ledger.next_batch(held)
    write_price_store(spark, root, f"{store}/batch={batch}", files=paths)
    ledger.record(new, ledger_path, batch)
    return len(paths)


def read_price_store(spark: SparkSession, store: str, ledger_path: str) -> DataFrame:
    """The long rows of every file's last batch (with the batch)."""
    rows = spark.read.schema(STORE_SCHEMA).option("basePath", store).parquet(store)
    return ledger.current(rows, ledger.read_ledger(spark, ledger_path))


def price_report(manifest: DataFrame, headers: DataFrame, store: DataFrame) -> DataFrame:
    """SK7: one row per price file: file, status (``loaded``, ``no header``, ``empty``), rows of the store,
    rows without a code. Reads the small columns of the written store, not the text."""
    rows = store.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("DSCode").isNull()).alias("bad_rows"))
    none = F.lit(0).cast("bigint")
    status = (F.when(F.col("size") == 0, "empty").when(F.col("header").isNull(), "no header").otherwise("loaded"))
    return (manifest.select("file", "size").join(headers.select("file", "header"), "file", "left").join(rows, "file", "left")
            .select("file", status.alias("status"), F.coalesce("rows", none).alias("rows"),
                    F.coalesce("bad_rows", none).alias("bad_rows")))


def split_legs(long: DataFrame):
    """(ri, mv) frames of the long price rows, value renamed per leg."""
    cols = ["DSCode", "Date", "Currency", "suffix"]
    ri = long.where(F.col("leg") == "RI").select(*cols, F.col("Value").alias("RI"))
    mv = long.where(F.col("leg") == "MV").select(*cols, F.col("Value").alias("MV"))
    return ri, mv
