"""File-to-file jobs on vendor-shaped files written from sf0.001."""

from pitpanel.plans import fixtures as fx
from pitpanel.plans import jobs as pl
from pitpanel.plans.catalog import q_matching_from_files, q_panel_c, q_price_panel_from_files
from pitpanel.plans.fixture_files import write_fundamentals_files, write_wide_price_files
from pitpanel.session import work_dir

SF = "/root/testdata/sf0.001"


def test_fundamentals_to_panels_and_predictors(spark):
    t = fx.Tables(spark, SF)
    ws, items, out = work_dir(spark, "ws"), work_dir(spark, "items"), work_dir(spark, "out")
    write_fundamentals_files(spark, t, ws)
    n = pl.fundamentals_job(spark, ws, items)
    final = spark.read.parquet(items)
    assert n == final.count() > 0
    p = pl.panels(final)
    # Files carry no order key and quote-stripped values, but the periods and
    # the lags are the same as on the in-memory chain.
    want = {r["fye_bin"]: tuple(r)[1:] for r in q_panel_c(spark, SF).collect()}
    got = {r["fye_bin"]: tuple(r)[1:] for r in p["panel_C_availability_at_FF92"].collect()}
    assert got == want
    pl.panels_job(spark, items, out + "/panels")
    pl.predictors_job(spark, items, out + "/pred")
    assert "Acc" in spark.read.parquet(out + "/pred").columns


def test_price_and_matching_jobs(spark):
    t = fx.Tables(spark, SF)
    ds, m, out = work_dir(spark, "ds"), work_dir(spark, "m"), work_dir(spark, "o")
    write_wide_price_files(spark, t, ds)
    fx.match_rows(t).write.option("header", "true").csv(m)
    assert pl.matching_job(spark, m, out + "/match") > 0
    assert pl.price_job(spark, ds, out + "/match", out + "/panel") > 0
    assert pl.price_job(spark, ds, out + "/match", out + "/panel", if_exists="skip") == 0
    assert spark.read.parquet(out + "/panel").count() == q_price_panel_from_files(spark, SF).count()
    assert spark.read.parquet(out + "/match").count() == q_matching_from_files(spark, SF).count()


def test_append_frames_and_attach_item_job(spark):
    import datetime as dt
    from pitpanel.sources import sinks
    d = dt.date(2020, 1, 1)
    out = work_dir(spark, "app")
    a = spark.createDataFrame([("C1", d, 1.0)], "WC06105 string, Date date, RI double")
    b = spark.createDataFrame([("C2", d, 2.0, 5.0)], "WC06105 string, Date date, RI double, MV double")
    sinks.append_frames([a, b], out + "/panel")
    panel = spark.read.parquet(out + "/panel")
    assert panel.count() == 2 and "MV" in panel.columns
    items = spark.createDataFrame([("C1", d, 2003, '"7"'), ("C1", d, 2003, '"8"'), ("C2", d, 5490, '"9"')],
                                  "ws_id string, point_date date, item_code bigint, value string")
    sinks.write_by_item(items, out + "/items")
    pl.attach_item_job(spark, out + "/panel", out + "/items", 2003, out + "/res")
    res = sorted((r["WC06105"], r["WS2003_PIT"]) for r in spark.read.parquet(out + "/res").collect())
    assert res == [("C1", '"7"'), ("C1", '"8"'), ("C2", None)]       # fan-out kept, no match -> NULL


def test_spine_equals_two_joins_with_duplicate_periods(spark):
    import datetime as dt
    from pitpanel.operators.joins import attach_periods
    d = dt.date(2020, 1, 1)
    facts = spark.createDataFrame([("c", d, "A", 1, 1), ("c", d, "A", 2, 2)],
                                  "ws_id string, point_date date, freq string, fiscal_period int, x int")
    cal1 = spark.createDataFrame([("c", d, "A", 1, "p"), ("c", d, "A", 1, "q")],
                                 "ws_id string, point_date date, freq string, fiscal_period int, c1 string")
    cal2 = spark.createDataFrame([("c", d, "A", "r"), ("c", d, "A", "s")],
                                 "ws_id string, point_date date, freq string, c2 string")
    k4, k3 = ["ws_id", "point_date", "freq", "fiscal_period"], ["ws_id", "point_date", "freq"]
    want = facts.join(cal1, k4, "left").join(cal2, k3, "left")
    got = attach_periods(facts, cal1, cal2)
    norm = lambda df: sorted(tuple(r[c] for c in ["x", "c1", "c2"]) for r in df.collect())
    assert norm(got) == norm(want) and len(norm(got)) == 6
