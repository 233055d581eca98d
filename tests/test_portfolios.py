"""Returns, holding spells, breakpoints and portfolio means on edge tables and against brute force."""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pitpanel.operators import portfolios as po
from pitpanel.plans import jobs
from pitpanel.plans import portfolios as pf
from pitpanel.session import work_dir


def day(text):
    return dt.date.fromisoformat(text) if text else None


PRICES = "DSCode string, Date date, Currency string, RI double, MV double"


def test_returns_over_years_gaps_and_bad_rows(spark):
    rows = [("A", "2000-12-29", "LC", 100.0, 7.0), ("A", "2001-01-02", "LC", 110.0, 8.0), ("A", "2001-01-03", "LC", None, 9.0),
            ("A", "2001-01-04", "LC", 55.0, None), ("A", "2004-06-01", "LC", 0.0, 1.0), ("A", "2004-06-02", "LC", 5.0, 1.0),
            ("A", "2004-06-02", "LC", 4.0, 2.0), ("A", None, "LC", 9.0, 9.0), ("A", "2000-12-30", "USD", 1.0, 1.0),
            ("B", "2001-01-03", "LC", 3.0, 3.0), (None, "2001-01-01", "LC", 1.0, 1.0), (None, "2001-01-02", "LC", 2.0, 1.0)]
    df = spark.createDataFrame([(a, day(b), c, d, e) for a, b, c, d, e in rows], PRICES)
    got = {(r.DSCode, str(r.Date), r.Currency): (r.ret, r.weight) for r in po.index_returns(df).collect()}
    assert got.pop((None, "2001-01-02", "LC")) == (1.0, 1.0)
    assert {k: (None if v[0] is None else round(v[0], 9), v[1]) for k, v in got.items()} == {
        ("A", "2001-01-02", "LC"): (0.1, 7.0),            # across the turn of the year
        ("A", "2001-01-04", "LC"): (-0.5, 8.0),           # a day without an index is passed over
        ("A", "2004-06-01", "LC"): (-1.0, None),          # across years without days
        ("A", "2004-06-02", "LC"): (None, 1.0)}           # after an index of zero; the smaller row counts
    assert po.index_returns(df.limit(0)).count() == 0


def test_returns_of_a_hot_security_match_a_plain_lag(spark):
    rng = random.Random(1)
    rows = [("HOT" if i % 3 else f"S{i % 40}", dt.date(1990, 1, 1) + dt.timedelta(days=rng.randrange(9000)), "LC",
             float(rng.randrange(1, 999)), float(i % 5)) for i in range(6000)]
    one = {}
    for s, d, c, i, w in rows:
        one[s, d] = min(one.get((s, d), (math.inf, 0.0)), (i, w))
    want, last = {}, {}
    for (s, d), (i, w) in sorted(one.items()):
        if s in last:
            want[s, d] = (round(i / last[s][0] - 1, 9), last[s][1])
        last[s] = (i, w)
    out = po.index_returns(spark.createDataFrame(rows, PRICES))
    assert {(r.DSCode, r.Date): (round(r.ret, 9), r.weight) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(DSCode" in plan and "y#" in plan.split("windowspecdefinition(DSCode")[1][:60]    # a security's year


PRED = "ws_id string, ff92_date date, pit_date date, fye_date date, P double, Q double"


def preds(spark, rows):
    return spark.createDataFrame([(a, day(b), day(c), day(d), p, q) for a, b, c, d, p, q in rows], PRED)


def test_holding_spells(spark):
    rows = [("C", "2000-06-30", "2000-05-01", "1999-12-31", 1.0, None), ("C", "2000-06-30", "2000-05-02", "1999-12-31", 2.0, 5.0),
            ("C", "2000-09-30", "2000-09-01", "2000-03-31", 3.0, 1.0), ("C", "2004-02-29", "2004-01-01", "2003-08-31", 4.0, 1.0),
            ("D", "2001-06-30", None, "2000-12-31", 9.0, 9.0), (None, "2001-06-30", "2001-01-01", "2000-12-31", 1.0, 1.0),
            ("E", None, "2001-01-01", "2000-12-31", 1.0, 1.0)]
    got = {(r.company, str(r.from_date)): (str(r.to_date), r.fye_bin, r.P, r.Q) for r in po.holding_spells(preds(spark, rows), ["P", "Q"]).collect()}
    assert got == {("C", "2000-06-30"): ("2000-09-30", "1995–1999", 2.0, 5.0),      # known last; until the next
                   ("C", "2000-09-30"): ("2001-09-30", "2000–2004", 3.0, 1.0),      # a year at most
                   ("C", "2004-02-29"): ("2005-02-28", "2000–2004", 4.0, 1.0),
                   ("D", "2001-06-30"): ("2002-06-30", "2000–2004", 9.0, 9.0)}


def test_held_days_are_those_from_start_to_before_the_end(spark):
    spells = po.holding_spells(preds(spark, [("C", "2000-06-30", "2000-05-01", "1999-12-31", 1.0, 1.0),
                                             ("C", "2000-12-31", "2000-05-01", "2000-06-30", 2.0, 1.0)]), ["P"])
    days = ["2000-06-29", "2000-06-30", "2000-12-30", "2000-12-31", "2001-01-01", "2001-12-30", "2001-12-31"]
    rets = spark.createDataFrame([(c, day(d), float(i)) for c in ("C", "X", None) for i, d in enumerate(days)],
                                 "WC06105 string, Date date, ret double")
    out = po.held_days(rets, spells)
    assert [(str(r.Date), r.P) for r in out.orderBy("Date").collect()] == [
        ("2000-06-30", 1.0), ("2000-12-30", 1.0), ("2000-12-31", 2.0), ("2001-01-01", 2.0), ("2001-12-30", 2.0)]
    assert "year" not in out.columns and out.columns.count("WC06105") == 1


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False))), max_size=60),
       st.integers(2, 7), st.sampled_from([2, 3, 32]))
def test_breakpoints_and_groups_match_ranks(spark, rows, n_groups, cells):
    df = spark.createDataFrame([(g, v) for g, v in rows], "g string, value double")
    found = po.breakpoints(df, ["g"], n_groups, cells=cells)
    by = defaultdict(list)
    for g, v in rows:
        if v is not None:
            by[g].append(v + 0.0)
    want = {g: (len(v), [sorted(v)[-(-i * len(v) // n_groups) - 1] for i in range(1, n_groups)]) for g, v in by.items()}
    assert {r.g: (r.n, [x + 0.0 for x in r.breaks]) for r in found.collect()} == want
    got = po.assign_groups(df.where("value IS NOT NULL"), found, ["g"])
    assert sorted(((r.g, r.value, r.portfolio) for r in got.collect()), key=repr) == \
        sorted(((g, v, 1 + sum(b < v for b in want[g][1])) for g, v in rows if v is not None), key=repr)


def test_a_hot_group_is_ordered_in_parts(spark):
    """No window holds a whole group's values: ranks are looked up within a part (group and cell)."""
    df = spark.range(20_000).selectExpr("CASE WHEN id % 10 < 9 THEN 'hot' ELSE 'g' END AS g", "double(hash(id) % 5000) AS value")
    found = po.breakpoints(df, ["g"], 10)
    values = defaultdict(list)
    for r in df.collect():
        values[r.g].append(r.value)
    assert {r.g: r.breaks for r in found.collect()} == {
        g: [sorted(v)[-(-i * len(v) // 10) - 1] for i in range(1, 10)] for g, v in values.items()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window " in line and "v#" in line:
            assert "cell#" in line


def test_means_and_spreads(spark):
    held = spark.createDataFrame([("p", 1, 0.1, 1.0), ("p", 1, 0.3, 3.0), ("p", 1, 0.5, None), ("p", 1, None, 9.0), ("p", 1, 0.2, -1.0),
                                  ("q", 1, 0.4, 0.0)], "predictor string, portfolio int, ret double, weight double")
    got = {r.predictor: (r.n, round(r.ew_return, 9), r.vw_return) for r in po.portfolio_means(held, ["predictor"]).collect()}
    assert got["p"][:2] == (4, 0.275) and math.isclose(got["p"][2], (0.1 + 0.9) / 4)
    assert got["q"] == (1, 0.4, None)
    rows = [("x", None, 1, 1, "2000-01-01", 0.1), ("x", None, 1, 5, "2000-01-01", 0.4), ("x", None, 1, 5, "2000-01-02", 0.9),
            ("x", None, 1, 3, "2000-01-01", 7.0), ("x", None, 1, 1, "2000-01-03", 0.5), ("x", None, 1, 5, "2000-01-03", 0.4)]
    rets = spark.createDataFrame([(a, b, c, d, day(e), f, f) for a, b, c, d, e, f in rows],
                                 "predictor string, fye_bin string, GEOGC int, portfolio int, Date date, ew_return double, vw_return double")
    r = pf.spreads(rets).first()
    assert (r.n_days, round(r.ew_spread, 9), round(r.vw_spread, 9)) == (2, 0.1, 0.1)


def test_portfolios_job(spark):
    out = work_dir(spark, "pf")
    rng = random.Random(4)
    table = [(f"C{i}", "2000-06-30", "2000-05-01", "1999-12-31", float(i), rng.random()) for i in range(10)]
    preds(spark, table).write.parquet(f"{out}/predictors")
    spark.createDataFrame([(f"S{i}", f"C{i}", 1) for i in range(10)], "DSCD string, WC06105 string, GEOGC int").write.parquet(f"{out}/match")
    prices = [(f"S{i}", dt.date(2000, 7, 1) + dt.timedelta(days=d), "LC", 100.0 + i * d, 1.0 + i, 1, f"C{i}") for i in range(10) for d in range(4)]
    spark.createDataFrame(prices, PRICES + ", GEOGC int, WC06105 string").write.parquet(f"{out}/panel")
    report = f"{out}/report"
    n = jobs.portfolios_job(spark, f"{out}/predictors", f"{out}/panel", f"{out}/match", f"{out}/folios", report=report)
    members = spark.read.parquet(f"{out}/folios/members")
    assert {(r.company, r.portfolio) for r in members.where("predictor = 'P'").collect()} == {(f"C{i}", i // 2 + 1) for i in range(10)}
    rets = spark.read.parquet(f"{out}/folios/returns")
    assert n == rets.count() == 2 * 5 * 3
    r = rets.where("predictor = 'P' AND portfolio = 5 AND Date = DATE'2000-07-02'").first()
    assert math.isclose(r.ew_return, (0.08 + 0.09) / 2) and math.isclose(r.vw_return, (9 * 0.08 + 10 * 0.09) / 19)
    assert {(x.job, x.source, x.rows) for x in spark.read.parquet(report).collect()} == {
        ("portfolios", "members", 20), ("portfolios", "returns", 30)}
    assert jobs.portfolios_job(spark, f"{out}/predictors", f"{out}/panel", f"{out}/match", f"{out}/folios", if_exists="skip") == 0
    with pytest.raises(Exception):
        pf.formation(spark.read.parquet(f"{out}/predictors"), spark.read.parquet(f"{out}/match"), ["absent"]).count()


def test_folio_items_are_written_once(spark):
    """Breakpoints, spells and both parts of ``split`` read written items, not the facts once more each."""
    from pitpanel.plans import catalog
    t = catalog._t(spark, "/root/testdata/sf0.001")
    plan = catalog._folio_predictors(t)._jdf.queryExecution().executedPlan().toString()
    assert "folio-items" in plan and "lineitem" not in plan and "orders" not in plan
