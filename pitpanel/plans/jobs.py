"""File-to-file jobs, the way a user runs the pipeline.

Each job is one lazy lineage ending in a write. Where several outputs
share an expensive input (the three lag panels; the text of the vendor files), the input is written
once as a table under the cluster's shared checkpoint folder and read
back: the lineage is cut, the shared work runs once, and a lost executor
only re-runs tasks of the current stage instead of the whole chain. A job that has written its output
deletes the tables it made on the way.

With ``if_exists="skip"`` a job leaves an output alone that was written
completely before (SK6). With ``report`` it appends what it loaded and wrote to that folder
(SK7, ``sinks.REPORT``): one row per input file - rows, malformed rows, files without content or
header - or per output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.operators import profile as prof
from pitpanel.operators.formulas import DEFAULT_REGISTRY, predictor_columns, registry_codes
from pitpanel.operators.joins import attach_item
from pitpanel.plans import fundamentals as fu
from pitpanel.plans import lag
from pitpanel.plans import portfolios as pf
from pitpanel.plans import prices as px
from pitpanel.plans.predictors import predictors, predictors_from_wide
from pitpanel.schemas import PANEL_FILES
from pitpanel.session import work_dir
from pitpanel.sources import sinks
from pitpanel.sources._fs import is_complete, list_files, remove
from pitpanel.sources.fundamentals import BAD, fundamentals_report, write_fundamentals_store
from pitpanel.sources.items import available_items, read_items
from pitpanel.sources.matching import read_matching_csv
from pitpanel.sources.prices import leg_pairs, price_headers, price_manifest, price_report, split_legs, write_price_store


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and read
    it back (a lineage cut that survives executor loss)."""
    path = work_dir(df.sparkSession, name)
    sinks.write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


def _skipped(spark: SparkSession, out: str, if_exists: str) -> bool:
    if if_exists not in ("overwrite", "skip"):
        raise ValueError("if_exists is 'overwrite' or 'skip'")
    return if_exists == "skip" and is_complete(spark, out)


def _write_counted(df: DataFrame, out: str, writer=sinks.write_parquet, job: str = "", report: str | None = None) -> int:
    """Write and return the number of rows handed to the writer (SK7: an
    observed metric filled by the write itself, no extra job; the item
    writer still drops rows without an item)."""
    df, obs = sinks.with_row_count(df)
    writer(df, out)
    rows = obs.get["rows"]
    if report:
        spark = df.sparkSession
        name = out.rstrip("/").rsplit("/", 1)[-1]
        sinks.append_report(spark.createDataFrame([(job, name, "written", rows, 0)], sinks.REPORT), report)
    return rows


def _base_name(c) -> F.Column:
    return F.element_at(F.split(c, "/"), -1)


def matching_job(spark: SparkSession, matching_dir: str, out: str, if_exists: str = "overwrite",
                 report: str | None = None) -> int:
    """CJ2: matching CSVs -> latest row per (DSCD, WC06105). Returns rows written."""
    if _skipped(spark, out, if_exists):
        return 0
    raw = read_matching_csv(spark, matching_dir)
    if report:
        path = work_dir(spark, "matching-raw")
        sinks.write_parquet(raw.withColumn("_file", F.col("_metadata.file_name")), path)
        raw = spark.read.parquet(path)
        files = [(p.rsplit("/", 1)[-1], n) for p, n in list_files(spark, matching_dir, recursive=False) if p.endswith(".csv")]
        found = raw.groupBy(F.col("_file").alias("source")).agg(F.count(F.lit(1)).alias("rows"))
        listed = spark.createDataFrame(files, "source string, size bigint")
        sinks.append_report(listed.join(found, "source", "left").select(
            F.lit("matching").alias("job"), "source", F.when(F.col("size") == 0, "empty").otherwise("loaded").alias("status"),
            F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(0).alias("bad_rows")), report)
        raw = raw.drop("_file")
    rows = _write_counted(px.matching_table(raw), out, job="matching", report=report)
    if report:
        remove(spark, path)
    return rows


def price_store(spark: SparkSession, ds_root: str, store: str, report: str | None = None) -> tuple:
    """(ri, mv, pairs) from wide price files: the text is scanned twice, for the headers and for the
    store that both legs are read from; the pairs come from the files' names."""
    manifest, headers = price_manifest(spark, ds_root), price_headers(spark, ds_root)
    long = write_price_store(spark, ds_root, store, headers)
    if report:
        sinks.append_report(price_report(manifest, headers, long).select(
            F.lit("prices").alias("job"), _base_name("file").alias("source"), "status", "rows", "bad_rows"), report)
    return (*split_legs(long), leg_pairs(manifest))


def price_job(spark: SparkSession, ds_root: str, matching_path: str, out: str,
              if_exists: str = "overwrite", report: str | None = None) -> int:
    """CJ1: wide price files -> paired legs -> panel with matching columns.
    Returns rows written."""
    if _skipped(spark, out, if_exists):
        return 0
    store = work_dir(spark, "price-store")
    ri, mv, pairs = price_store(spark, ds_root, store, report)
    rows = _write_counted(px.price_panel(ri, mv, spark.read.parquet(matching_path), pairs), out, job="prices", report=report)
    remove(spark, store)
    return rows


def fundamentals_job(spark: SparkSession, ws_root: str, items_out: str,
                     facts_kind: str = "WSFV", if_exists: str = "overwrite", report: str | None = None) -> int:
    """CJ3: fundamentals files -> periods attached and filtered -> one folder
    per item. The text of each kind is parsed once. Returns rows written."""
    if _skipped(spark, items_out, if_exists):
        return 0
    store = work_dir(spark, "ws-store")
    k = write_fundamentals_store(spark, ws_root, store, [facts_kind, "WSCalendarPrd", "WSReportedPrd"])
    if report:
        sinks.append_report(fundamentals_report(k).select(F.lit("fundamentals").alias("job"), F.col("file").alias("source"),
                                                          "status", "rows", "bad_rows"), report)
    k = {kind: df.drop(BAD) for kind, df in k.items()}
    final = fu.fundamentals(k[facts_kind], k["WSCalendarPrd"], k["WSReportedPrd"]).drop("ord")
    rows = _write_counted(final, items_out, sinks.write_by_item, "fundamentals", report)
    remove(spark, store)
    return rows


def profile(df: DataFrame, cols=None, k: int = 10) -> tuple:
    """CJ9: (NULL and distinct counts, top-k values) of ``cols`` (default: the last two columns), both from
    one written histogram: the input is read once whatever the number of columns."""
    hist = materialize(prof.value_histogram(df, list(cols) if cols is not None else df.columns[-2:]), "profile-histogram")
    return prof.histogram_profile(hist), prof.histogram_top(hist, k)


def panels(final_no_cols: DataFrame, std_digits=None) -> dict:
    """CJ4-CJ6 from one small table, the lags' histogram: the facts are read once."""
    hist = materialize(lag.lag_histogram(lag.lag_features(final_no_cols)), "lag-histogram")
    return {
        PANEL_FILES["a"]: lag.panel_a(hist, std_digits, "n"),
        PANEL_FILES["b"]: lag.panel_b(hist, std_digits, "n"),
        PANEL_FILES["c"]: lag.panel_c(hist, "n"),
        PANEL_FILES["after"]: lag.panel_after(hist, std_digits, "n"),
        PANEL_FILES["before"]: lag.panel_before(hist, std_digits, "n"),
        PANEL_FILES["counts"]: lag.lag_counts(hist, "n"),
    }


def panels_job(spark: SparkSession, final_path: str, out_dir: str, if_exists: str = "overwrite",
               report: str | None = None) -> None:
    """Write every panel as a CSV with header (SK2)."""
    if _skipped(spark, f"{out_dir}/{PANEL_FILES['counts']}", if_exists):          # the last one written
        return
    for name, df in panels(spark.read.parquet(final_path)).items():
        _write_counted(df, f"{out_dir}/{name}", sinks.write_panel_csv, "panels", report)


def predictors_job(spark: SparkSession, items_dir: str, out: str,
                   registry=DEFAULT_REGISTRY, mode: str = "split",
                   wide_path: str | None = None, if_exists: str = "overwrite", report: str | None = None) -> int:
    """CJ7: needed items (missing ones warned and skipped) -> one row per
    company-period -> dates -> formulas. Without any item partition, the
    wide table's ``cal1_<code>`` columns are used (RS4). Returns rows written."""
    if _skipped(spark, out, if_exists):
        return 0
    codes = available_items(spark, items_dir, registry_codes(registry))
    if codes:
        df = predictors(read_items(spark, items_dir, codes), registry, mode=mode, codes=codes)
    elif wide_path:
        df = predictors_from_wide(spark.read.parquet(wide_path), registry)
    else:
        raise RuntimeError("no item partitions and no wide table")
    return _write_counted(df, out, job="predictors", report=report)


def attach_item_job(spark: SparkSession, panel_path: str, items_dir: str, code: int,
                    out: str, if_exists: str = "overwrite", report: str | None = None) -> int:
    """CJ8: price panel + one item's value on (company, exact date). Returns rows written."""
    if _skipped(spark, out, if_exists):
        return 0
    item = read_items(spark, items_dir, [code]).withColumn("point_date", F.col("point_date").cast("date"))
    return _write_counted(attach_item(spark.read.parquet(panel_path), item, f"WS{code}_PIT"), out, job="attach_item", report=report)


def portfolios_job(spark: SparkSession, predictors_path: str, panel_path: str, matching_path: str, out: str, names=None,
                   n_groups: int = 5, hold_months: int = 12, if_exists: str = "overwrite", report: str | None = None) -> int:
    """OP2: predictor table and price panel -> portfolio members and mean returns below ``out``. ``names``: the
    predictors, by default every numeric column (PR7). Returns the rows of the returns."""
    if _skipped(spark, f"{out}/returns", if_exists):
        return 0
    table = spark.read.parquet(predictors_path)
    names = list(names) if names is not None else predictor_columns(table)
    matching = spark.read.parquet(matching_path)
    formed = work_dir(spark, "formation")
    sinks.write_parquet(pf.formation(table, matching, names, hold_months), formed)
    _write_counted(pf.members(spark.read.parquet(formed), n_groups), f"{out}/members", job="portfolios", report=report)
    remove(spark, formed)
    prices = spark.read.parquet(panel_path).select("DSCode", "Date", "Currency", "RI", "MV")
    returns = pf.portfolio_returns(prices, matching, spark.read.parquet(f"{out}/members"))
    return _write_counted(returns, f"{out}/returns", job="portfolios", report=report)
