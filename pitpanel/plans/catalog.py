"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the driver's tables (see fixtures)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions import header_date_text, parse_date
from pitpanel.operators import profile as prof
from pitpanel.operators.clean import dedup_rows, drop_missing_period, keep_recent
from pitpanel.operators.formulas import ACC, Predictor, predictor_columns, registry_codes
from pitpanel.operators.joins import attach_item as _attach_item
from pitpanel.operators.reshape import items_wide, unpivot_dates
from pitpanel.plans import fixtures as fx
from pitpanel.plans import fundamentals as fu
from pitpanel.plans import lag
from pitpanel.plans import portfolios as pf
from pitpanel.plans import predictors as pr
from pitpanel.plans import prices as px
from pitpanel.schemas import ITEM_KEYS, MATCH_KEYS
from pitpanel.session import work_dir
from pitpanel.sources import sinks
from pitpanel.sources._charset import ensure_charset
from pitpanel.sources.items import available_items, read_items

# Items of the accruals predictor and the order that picks one row per
# (company-period, item) in the de-duplicating mode.
ACC_CODES = sorted(ACC.codes())
DEDUP_ORDER = ["value", "l_partkey", "l_suppkey"]
STD_DIGITS = 6   # sample std rounded for cross-engine comparison


def _t(spark, sf_dir) -> fx.Tables:
    return fx.Tables(spark, sf_dir)


def _merged(t) -> DataFrame:
    return fu.merged(fx.facts(t), fx.calendar(t), fx.reported(t))


def _final(t) -> DataFrame:
    return fu.final(_merged(t))


def _final_no_cols(t) -> DataFrame:
    return fu.final_no_cols(_merged(t))


def _features(t) -> DataFrame:
    return lag.lag_features(_final_no_cols(t))


def _write_items(spark, t) -> str:
    path = work_dir(spark, "items")
    sinks.write_by_item(_final_no_cols(t), path)
    return path


# --- fundamentals chain -----------------------------------------------------

def q_pivot_calendar(spark, d):
    return fu.calendar_wide(fx.calendar(_t(spark, d)))


def q_pivot_reported(spark, d):
    return fu.reported_wide(fx.reported(_t(spark, d)))


def q_fundamentals_merged(spark, d):
    return _merged(_t(spark, d))


def q_drop_missing_period(spark, d):
    return drop_missing_period(_merged(_t(spark, d)))


def q_keep_recent(spark, d):
    return keep_recent(drop_missing_period(_merged(_t(spark, d))))


def q_drop_columns(spark, d):
    return _final_no_cols(_t(spark, d))


def q_split_by_item(spark, d):
    path = _write_items(spark, _t(spark, d))
    return spark.read.parquet(path).withColumn("item_code", F.col("item_code").cast("bigint"))


def q_item_filter(spark, d):
    path = _write_items(spark, _t(spark, d))
    return read_items(spark, path, [2003])


def q_item_codes(spark, d):
    return fu.item_codes(_final(_t(spark, d)))


# --- lag panels ---------------------------------------------------------------

def q_lag_features(spark, d):
    return _features(_t(spark, d))


def q_year_bins(spark, d):
    return _features(_t(spark, d)).select("fye_year", "fye_bin").distinct()


def q_panel_a(spark, d):
    return lag.panel_a(_features(_t(spark, d)), STD_DIGITS)


def q_panel_b(spark, d):
    return lag.panel_b(_features(_t(spark, d)), STD_DIGITS)


def q_panel_c(spark, d):
    return lag.panel_c(_features(_t(spark, d)))


def q_panel_c_merged(spark, d):
    return lag.panel_c(lag.lag_features(_merged(_t(spark, d))))


def q_panel_after(spark, d):
    return lag.panel_after(_features(_t(spark, d)), STD_DIGITS)


def q_panel_before(spark, d):
    return lag.panel_before(_features(_t(spark, d)), STD_DIGITS)


def q_lag_counts(spark, d):
    return lag.lag_counts(_features(_t(spark, d)))


def q_panel_set(spark, d):
    """CJ4, CJ5 as the job runs them: the distributions of all four panels from one histogram."""
    from functools import reduce
    from pitpanel.plans.jobs import panels
    done = panels(_final_no_cols(_t(spark, d)), STD_DIGITS)
    names = ("panel_A_diff_pit_to_fye", "panel_B_diff_pit_to_ff92", "panel_after_ff92_only", "panel_before_ff92_only")
    return reduce(DataFrame.unionByName, [done[n].select(F.lit(n).alias("panel"), "*") for n in names])


# --- items and predictors -------------------------------------------------------

def q_items_wide_chain(spark, d):
    # Every item part scans the input: write it once (shared folder) instead
    # of re-deriving it per item.
    from pitpanel.plans.jobs import materialize
    return items_wide(materialize(_final(_t(spark, d)), "final"), ACC_CODES, mode="chain")


def q_items_wide_split(spark, d):
    from pitpanel.plans.jobs import materialize
    return items_wide(materialize(_final(_t(spark, d)), "final"), ACC_CODES, mode="split")


def q_items_wide_dedup(spark, d):
    return items_wide(_final(_t(spark, d)), ACC_CODES, mode="dedup", order_cols=DEDUP_ORDER)


def q_items_wide_pivot(spark, d):
    """The checked pivot, on one row per company-period and item."""
    one = (_final(_t(spark, d)).groupBy(*ITEM_KEYS, "item_code")
           .agg(F.min(F.struct(*DEDUP_ORDER))["value"].alias("value")))
    return items_wide(one, ACC_CODES, mode="pivot")


def q_items_wide_fallback(spark, d):
    """RS4: items from the ``cal1_<code>`` columns of a wide table."""
    wide = _final(_t(spark, d)).groupBy(*ITEM_KEYS).agg(*[
        F.min(F.when(F.col("item_code") == c, F.struct(*DEDUP_ORDER)))["value"].alias(f"cal1_{c}") for c in ACC_CODES])
    return pr.predictors_from_wide(wide)


def q_predictor_acc(spark, d):
    """CJ7: the default registry, duplicates of an item multiplied as joins do."""
    from pitpanel.plans.jobs import materialize
    final = _final(_t(spark, d)).where(F.col("item_code").isin(ACC_CODES)).select(*ITEM_KEYS, "item_code", "value")
    return pr.predictors(materialize(final, "acc-items"), mode="split")


# A registry with a dependent formula and one whose input item is absent.
DEMO_REGISTRY = (
    ACC,
    Predictor("AccPct", "Acc * 100"),
    Predictor("SGA_TA", "SGA / TA", (1101, 6699)),
)


def q_predictor_registry(spark, d):
    t = _t(spark, d)
    path = _write_items(spark, t)
    codes = available_items(spark, path, registry_codes(DEMO_REGISTRY))
    return pr.predictors(read_items(spark, path, codes), DEMO_REGISTRY, mode="chain",
                         codes=codes)


# Growth and change over the fiscal year before, a nested division and a CASE divisor.
GROWTH_REGISTRY = (
    Predictor("AssetGrowth", "(CA - prev_CA) / prev_CA"),
    Predictor("RatioChange", "CA / CL - prev_CA / prev_CL"),
    Predictor("PerRisk", "CA / CASE WHEN CL > CA THEN CL / (CA / 2) ELSE CL - CL END"),
)


def q_predictor_growth(spark, d):
    """OP1: predictors with the year before's items; NULL where the years have a gap."""
    from pitpanel.plans.jobs import materialize
    final = _final(_t(spark, d)).where(F.col("item_code").isin(2201, 3101)).select(*ITEM_KEYS, "item_code", "value")
    return pr.predictors(materialize(final, "growth-items"), GROWTH_REGISTRY, mode="split")


def q_predictor_columns(spark, d):
    df = pr.predictors(_final(_t(spark, d)), mode="dedup", order_cols=DEDUP_ORDER)
    return df.select(*ITEM_KEYS, *predictor_columns(df))


# --- portfolios ---------------------------------------------------------------

# Two predictors on items most company-periods have.
FOLIO_REGISTRY = (Predictor("CurrentRatio", "CA / CL"), Predictor("WorkingCapital", "(CA - CL) / CA"))
FOLIO_NAMES = [p.name for p in FOLIO_REGISTRY]


def _folio_predictors(t) -> DataFrame:
    """From the registry's items and the period markers that are read, written once: ``split`` reads its
    input once per part."""
    from pitpanel.plans.jobs import materialize
    facts = fx.facts(t).where(F.col("item_code").isin(registry_codes(FOLIO_REGISTRY)))
    calendar = fx.calendar(t).where(F.col("item_code").isin(55350, 55555))
    final = fu.final(fu.merged(facts, calendar, fx.reported(t))).select(*ITEM_KEYS, "item_code", "value")
    return pr.predictors(materialize(final, "folio-items"), FOLIO_REGISTRY, mode="split")


def _members(t) -> DataFrame:
    from pitpanel.plans.jobs import materialize
    return pf.members(materialize(pf.formation(_folio_predictors(t), fx.company_match(t), FOLIO_NAMES), "formation"))


def q_index_returns(spark, d):
    """OP2: change of the return index since the security's previous day."""
    from pitpanel.operators.portfolios import index_returns
    return index_returns(fx.security_prices(_t(spark, d)))


def q_returns_joined(spark, d):
    """OP2: returns on the days on which their company's predictors hold."""
    t = _t(spark, d)
    return pf.returns_joined(fx.security_prices(t), fx.company_match(t), _folio_predictors(t), FOLIO_NAMES)


def q_portfolio_members(spark, d):
    """OP2: exact breakpoints per predictor, bin and country, and each company's portfolio."""
    return _members(_t(spark, d))


def q_portfolio_returns(spark, d):
    """OP2: equal- and value-weighted mean returns per portfolio and day."""
    t = _t(spark, d)
    return pf.portfolio_returns(fx.security_prices(t), fx.company_match(t), _members(t))


def q_portfolio_spreads(spark, d):
    """OP2: mean return of the highest minus the lowest portfolio."""
    return pf.spreads(q_portfolio_returns(spark, d))


# --- price side -------------------------------------------------------------

def _long_wide(t) -> DataFrame:
    return unpivot_dates(fx.wide_prices(t), ["DSCode", "Currency", "leg"], n_meta=3,
                         name_col="Date", value_col="Value")


def q_unpivot_prices(spark, d):
    return _long_wide(_t(spark, d))


def q_date_header_extract(spark, d):
    long = _long_wide(_t(spark, d))
    # The date is parsed from the extracted column (the regex runs once per row).
    return (long.select("DSCode", "Currency", "leg", F.col("Date").alias("header"),
                        header_date_text("Date").alias("CleanDate"))
            .withColumn("Date", parse_date("CleanDate", "dd/MM/yyyy")))


def q_lenient_cast(spark, d):
    return px.long_prices(_long_wide(_t(spark, d)), "Price")


def q_price_join(spark, d):
    t = _t(spark, d)
    return px.price_panel(fx.price_ri(t), fx.price_mv(t))


def q_price_union(spark, d):
    t = _t(spark, d)
    return px.union_legs(fx.price_ri(t), fx.price_mv(t))


def _match_latest(t):
    return px.matching_table(fx.match_rows(t))


def q_match_latest(spark, d):
    return _match_latest(_t(spark, d))


def q_match_dedup_nodate(spark, d):
    return dedup_rows(fx.match_rows(_t(spark, d)).drop("TIME"), MATCH_KEYS)


def q_price_match(spark, d):
    t = _t(spark, d)
    return px.price_panel(fx.price_ri(t), fx.price_mv(t), _match_latest(t))


def q_attach_item(spark, d):
    t = _t(spark, d)
    item = fx.facts(t).where(F.col("item_code") == 2003)
    return _attach_item(fx.price_panel_keys(t), item, "WS2003_PIT")


# --- profiling ----------------------------------------------------------------

def q_profile_nulls(spark, d):
    """AG13, AG14: from the histogram of the last two columns."""
    m = _merged(_t(spark, d))
    return prof.column_profile(m, m.columns[-2:])


def q_profile_top10(spark, d):
    """AG11: one column's frequent values, in the column's own type."""
    return prof.top_values(_merged(_t(spark, d)), "cal2_55559", 10)


def q_profile_columns(spark, d):
    """CJ9: every column's counts and ten most frequent values from one written histogram."""
    from pitpanel.plans.jobs import profile
    m = _merged(_t(spark, d))
    counts, top = profile(m, m.columns)
    return top.join(counts, "column_name")


def q_table_shape(spark, d):
    return prof.shape_row(_merged(_t(spark, d)))


def q_value_counts(spark, d):
    return prof.value_counts(_final(_t(spark, d)), "freq")


def q_head_export(spark, d):
    df = _final_no_cols(_t(spark, d))
    path = work_dir(spark, "head")
    sinks.export_head(df, path, 10_000)
    return spark.read.schema(df.schema).option("header", "true").csv(path)


# --- file sources and sinks --------------------------------------------------

def q_fundamentals_from_files(spark, d):
    """SC5/SC6 + CJ3: pipe files (each kind's text parsed once, file order as "first"). The facts, which the
    join reads twice, come from a typed store; each period kind is read once, from its text."""
    from pitpanel.plans.fixture_files import write_fundamentals_files
    from pitpanel.sources.fundamentals import BAD, read_fundamentals, write_fundamentals_store
    root = work_dir(spark, "ws")
    write_fundamentals_files(spark, _t(spark, d), root)
    k = {**read_fundamentals(spark, root, ["WSCalendarPrd", "WSReportedPrd"]),
         **write_fundamentals_store(spark, root, work_dir(spark, "ws-store"), ["WSFV"])}
    k = {kind: df.drop(BAD) for kind, df in k.items()}
    return fu.merged(k["WSFV"], k["WSCalendarPrd"], k["WSReportedPrd"]).drop("ord")


def q_fundamentals_to_items(spark, d):
    """CJ3 from the files (of any value kind) to the item write, read back."""
    from pitpanel.plans.fixture_files import write_fundamentals_files
    from pitpanel.plans.jobs import fundamentals_job
    root, out = work_dir(spark, "ws"), work_dir(spark, "items")
    write_fundamentals_files(spark, _t(spark, d), root, facts_kind="WSSupplemental")
    fundamentals_job(spark, root, out, facts_kind="WSSupplemental")
    return spark.read.parquet(out).withColumn("item_code", F.col("item_code").cast("bigint"))


def q_pipe_notes(spark, d):
    """SC5: notes with line breaks, separators and quotes; malformed rows kept and marked."""
    from pitpanel.plans.fixture_files import write_note_files
    from pitpanel.sources.fundamentals import BAD, read_fundamentals
    root = work_dir(spark, "notes")
    write_note_files(spark, _t(spark, d), root)
    notes = read_fundamentals(spark, root, bad=True)["WSFVFootnote"]
    return notes.withColumn("is_bad", F.col(BAD).isNotNull()).drop("ord", BAD)


def q_pipe_scan(spark, d):
    """SC5/SC6 alone: one kind's pipe files, typed (codes bigint, dates parsed)."""
    from pitpanel.plans.fixture_files import write_fundamentals_files
    from pitpanel.sources.fundamentals import read_fundamentals
    root = work_dir(spark, "pipe")
    write_fundamentals_files(spark, _t(spark, d), root, kinds=["WSReportedPrd"])
    return read_fundamentals(spark, root)["WSReportedPrd"].drop("ord")


def q_wide_price_files(spark, d):
    """SC1-SC4 + RS1 on files: all wide CSVs in one text scan."""
    from pitpanel.plans.fixture_files import write_wide_price_files
    from pitpanel.sources.prices import wide_prices_long
    root = work_dir(spark, "ds")
    write_wide_price_files(spark, _t(spark, d), root)
    return wide_prices_long(spark, root).drop("file")


def q_price_panel_from_files(spark, d):
    """CJ1 from files: one typed store, legs paired by the files' names, joined, matched."""
    from pitpanel.plans.fixture_files import write_wide_price_files
    from pitpanel.plans.jobs import price_store
    t = _t(spark, d)
    root = work_dir(spark, "ds")
    write_wide_price_files(spark, t, root)
    ri, mv, pairs = price_store(spark, root, work_dir(spark, "price-store"))
    return px.price_panel(ri, mv, _match_latest(t), pairs)


def q_incremental_load(spark, d):
    """SK6 per input file: a second delivery, then a run without one; each file's batch and rows."""
    from pitpanel.plans.fixture_files import move, write_wide_price_files
    from pitpanel.sources.prices import read_price_store, update_price_store
    made, root, store, ledger = (work_dir(spark, n) for n in ("made", "ds", "price-store", "price-ledger"))
    write_wide_price_files(spark, _t(spark, d), made)
    new = []
    for folder in ("LC", "USD", None):
        if folder:
            move(spark, f"{made}/{folder}", f"{root}/{folder}")
        new.append(update_price_store(spark, root, store, ledger))
    rows = read_price_store(spark, store, ledger)
    return (rows.groupBy(F.element_at(F.split("file", "/"), -1).alias("file"), "batch").agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("new_files", F.element_at(F.array(*[F.lit(n) for n in new]), F.col("batch")))
            .withColumn("new_in_last_run", F.lit(new[-1])))


def q_load_report(spark, d):
    """SK7: what all six jobs report, by input kind or file and by output."""
    from pitpanel.plans import jobs
    from pitpanel.plans.fixture_files import write_empty, write_fundamentals_files, write_wide_price_files
    t, root, report = _t(spark, d), work_dir(spark, "in"), work_dir(spark, "report")
    out = work_dir(spark, "out")
    fx.match_rows(t).write.option("header", "true").csv(f"{root}/match")
    write_empty(spark, f"{root}/match/empty.csv")
    write_wide_price_files(spark, t, f"{root}/ds")
    write_fundamentals_files(spark, t, f"{root}/ws")
    jobs.matching_job(spark, f"{root}/match", f"{out}/match", report=report)
    jobs.price_job(spark, f"{root}/ds", f"{out}/match", f"{out}/panel", report=report)
    jobs.fundamentals_job(spark, f"{root}/ws", f"{out}/items", report=report)
    jobs.panels_job(spark, f"{out}/items", f"{out}/panels", report=report)
    jobs.predictors_job(spark, f"{out}/items", f"{out}/predictors", report=report)
    jobs.attach_item_job(spark, f"{out}/panel", f"{out}/items", 2003, f"{out}/panel_item", report=report)
    kind = F.regexp_extract("source", "^(WS[A-Za-z]+)_?", 1)
    source = (F.when(F.col("status") == "written", F.col("source")).when(F.col("job") == "fundamentals", kind)
              .when((F.col("job") == "matching") & (F.col("status") == "loaded"), "csv").otherwise(F.col("source")))
    return (spark.read.schema(sinks.REPORT).parquet(report).groupBy("job", source.alias("source"), "status")
            .agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows")))


def q_panel_with_item(spark, d):
    """CJ8 end to end: price panel with its companies, item table from the facts, exact dates."""
    from pitpanel.operators.joins import attach_matching
    from pitpanel.plans.jobs import attach_item_job
    t, out = _t(spark, d), work_dir(spark, "cj8")
    sinks.write_parquet(attach_matching(fx.security_prices(t), fx.company_match(t)), f"{out}/panel")
    items = _write_items(spark, t)
    attach_item_job(spark, f"{out}/panel", items, 2201, f"{out}/joined")
    return spark.read.parquet(f"{out}/joined")


def q_matching_from_files(spark, d):
    """SC7 + CJ2: matching CSVs (plus an empty file), all columns text."""
    from pitpanel.sources.matching import read_matching_csv
    root = work_dir(spark, "match")
    (fx.match_rows(_t(spark, d)).write.mode("overwrite").option("header", "true")
     .option("encoding", ensure_charset(spark, "windows-1252")).csv(root))
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{root}/empty.csv")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p).close()
    return px.matching_table(read_matching_csv(spark, root))


def q_parquet_append(spark, d):
    """SK5 + SC10: two writes with different columns into one folder, read
    back as one frame unioned by name."""
    from pitpanel.sources.matching import read_parquet_folder
    t = _t(spark, d)
    root = work_dir(spark, "append")
    sinks.write_parquet(fx.price_ri(t).drop("suffix"), root, mode="append")
    sinks.write_parquet(fx.price_mv(t), root, mode="append")
    return read_parquet_folder(spark, root)


def q_parquet_quarantine(spark, d):
    """SC10: a folder with unreadable files: the good rows, and the names of the bad files."""
    from pitpanel.plans.fixture_files import write_lines
    from pitpanel.sources.matching import quarantine
    t = _t(spark, d)
    root = work_dir(spark, "quarantine")
    sinks.write_parquet(fx.price_ri(t), root, mode="append")
    sinks.write_parquet(fx.price_mv(t), root, mode="append")
    for name in ("broken_1", "broken_2"):
        write_lines(spark, spark.createDataFrame([("PAR1 cut off",)], "line string").coalesce(1), root, name, "parquet")
    good, bad = quarantine(spark, root)
    names = sorted(r.file.rsplit("/", 1)[-1] for r in bad.collect())    # names only
    return good.withColumn("bad_files", F.lit(",".join(names)))


def q_panel_append(spark, d):
    """SK5: the price panels of both currencies into one dataset, in one write."""
    t = _t(spark, d)
    panel = px.price_panel(fx.price_ri(t), fx.price_mv(t))
    root = work_dir(spark, "panels")
    sinks.append_frames([panel.where(F.col("Currency") == c) for c in ("LC", "USD")], root)
    return spark.read.parquet(root)


def q_skip_existing(spark, d):
    """SK6: the second run of a job leaves the written output alone."""
    from pitpanel.plans.jobs import matching_job
    rows, root = fx.match_rows(_t(spark, d)), work_dir(spark, "skip")
    for part, name in ((rows, "first"), (rows.where(F.lit(False)), "second")):
        part.write.option("header", "true").csv(f"{root}/{name}")
        matching_job(spark, f"{root}/{name}", f"{root}/out", if_exists="skip")
    return spark.read.parquet(f"{root}/out")


def q_csv_roundtrip(spark, d):
    """SK2: a result panel to CSV with header, read back with its schema."""
    df = q_panel_c_merged(spark, d)
    root = work_dir(spark, "panel")
    sinks.write_panel_csv(df, root)
    return spark.read.schema(df.schema).option("header", "true").csv(root)


def q_stream_ingest(spark, d):
    """Streaming ingestion (availableNow) of pipe files into the item table."""
    from pitpanel.plans.fixture_files import write_fundamentals_files
    from pitpanel.streaming.ingest import ingest_items
    src, out = work_dir(spark, "ws-src"), work_dir(spark, "ws-items")
    write_fundamentals_files(spark, _t(spark, d), src)
    ingest_items(spark, src, "WSCalendarPrd", out).awaitTermination()
    return (spark.read.parquet(out).drop("source_file", "batch")
            .withColumn("item_code", F.col("item_code").cast("bigint")))


QUERIES = {
    "pivot_calendar": q_pivot_calendar,
    "pivot_reported": q_pivot_reported,
    "fundamentals_merged": q_fundamentals_merged,
    "drop_missing_period": q_drop_missing_period,
    "keep_recent": q_keep_recent,
    "drop_columns": q_drop_columns,
    "split_by_item": q_split_by_item,
    "item_filter": q_item_filter,
    "item_codes": q_item_codes,
    "lag_features": q_lag_features,
    "year_bins": q_year_bins,
    "panel_a": q_panel_a,
    "panel_b": q_panel_b,
    "panel_c": q_panel_c,
    "panel_c_merged": q_panel_c_merged,
    "panel_after": q_panel_after,
    "panel_before": q_panel_before,
    "lag_counts": q_lag_counts,
    "panel_set": q_panel_set,
    "items_wide_chain": q_items_wide_chain,
    "items_wide_split": q_items_wide_split,
    "items_wide_pivot": q_items_wide_pivot,
    "items_wide_dedup": q_items_wide_dedup,
    "items_wide_fallback": q_items_wide_fallback,
    "predictor_acc": q_predictor_acc,
    "predictor_registry": q_predictor_registry,
    "predictor_growth": q_predictor_growth,
    "predictor_columns": q_predictor_columns,
    "index_returns": q_index_returns,
    "returns_joined": q_returns_joined,
    "portfolio_members": q_portfolio_members,
    "portfolio_returns": q_portfolio_returns,
    "portfolio_spreads": q_portfolio_spreads,
    "unpivot_prices": q_unpivot_prices,
    "date_header_extract": q_date_header_extract,
    "lenient_cast": q_lenient_cast,
    "price_join": q_price_join,
    "price_union": q_price_union,
    "match_latest": q_match_latest,
    "match_dedup_nodate": q_match_dedup_nodate,
    "price_match": q_price_match,
    "attach_item": q_attach_item,
    "profile_nulls": q_profile_nulls,
    "profile_top10": q_profile_top10,
    "profile_columns": q_profile_columns,
    "table_shape": q_table_shape,
    "value_counts": q_value_counts,
    "head_export": q_head_export,
    "fundamentals_from_files": q_fundamentals_from_files,
    "fundamentals_to_items": q_fundamentals_to_items,
    "pipe_scan": q_pipe_scan,
    "pipe_notes": q_pipe_notes,
    "wide_price_files": q_wide_price_files,
    "price_panel_from_files": q_price_panel_from_files,
    "incremental_load": q_incremental_load,
    "load_report": q_load_report,
    "panel_with_item": q_panel_with_item,
    "matching_from_files": q_matching_from_files,
    "parquet_append": q_parquet_append,
    "parquet_quarantine": q_parquet_quarantine,
    "panel_append": q_panel_append,
    "skip_existing": q_skip_existing,
    "csv_roundtrip": q_csv_roundtrip,
    "stream_ingest": q_stream_ingest,
}
