import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitpanel.operators.joins import (assert_unique, attach_item, attach_matching, attach_periods,
                                      attach_year_bins, join_legs)
from pitpanel.operators.reshape import items_wide, pivot_first, unpivot_dates

D = dt.date(2020, 1, 1)


def test_first_value_null_stays_null(spark):
    df = spark.createDataFrame([("k", 1, None, 1), ("k", 1, "5", 2)],
                               "k string, item_code int, value string, ord int")
    r = pivot_first(df, ["k"], [1], "c_").collect()[0]
    assert r["c_1"] is None


def test_first_value_by_order(spark):
    df = spark.createDataFrame([("k", 1, "b", 2), ("k", 1, "a", 3), ("k", 2, "z", 1)],
                               "k string, item_code int, value string, ord int")
    r = pivot_first(df, ["k"], [1, 2, 3], "c_").collect()[0]
    assert (r["c_1"], r["c_2"], r["c_3"]) == ("b", "z", None)


def test_unpivot_then_pivot_identity(spark):
    wide = spark.createDataFrame([("a", "1", None), ("b", "3", "4")], "id string, `01/01/2024` string, `02/01/2024` string")
    long = unpivot_dates(wide, ["id"], n_meta=1, name_col="h", value_col="v")
    assert long.count() == 4                     # NULL cells kept
    back = long.groupBy("id").pivot("h", ["01/01/2024", "02/01/2024"]).agg(F.max("v"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_null_keys_never_match(spark):
    left = spark.createDataFrame([(None, D, "LC", "s", 1.0)], "DSCode string, Date date, Currency string, suffix string, RI double")
    right = spark.createDataFrame([(None, D, "LC", "s", 2.0)], "DSCode string, Date date, Currency string, suffix string, MV double")
    r = join_legs(left, right).collect()
    assert len(r) == 1 and r[0]["MV"] is None
    m = spark.createDataFrame([(None, 1, "W")], "DSCD string, GEOGC int, WC06105 string")
    assert attach_matching(left, m).collect()[0]["GEOGC"] is None
    item = spark.createDataFrame([(None, D, "v")], "ws_id string, point_date date, value string")
    panel = spark.createDataFrame([(None, D)], "WC06105 string, Date date")
    assert attach_item(panel, item, "X").collect()[0]["X"] is None


def test_unpaired_leg_dropped_and_fanout(spark):
    ri = spark.createDataFrame([("A", D, "LC", "1", 1.0), ("B", D, "USD", "2", 2.0)],
                               "DSCode string, Date date, Currency string, suffix string, RI double")
    mv = spark.createDataFrame([("A", D, "LC", "1", 9.0)], "DSCode string, Date date, Currency string, suffix string, MV double")
    r = join_legs(ri, mv).collect()
    assert [x["DSCode"] for x in r] == ["A"]
    m = spark.createDataFrame([("A", 1, "W1"), ("A", 2, "W2")], "DSCD string, GEOGC int, WC06105 string")
    assert attach_matching(join_legs(ri, mv), m).count() == 2


def test_attach_periods_equals_two_joins(spark):
    facts = spark.createDataFrame(
        [("c", D, "A", 2020, 1), ("c", D, "A", None, 2), ("c", D, "A", 2021, 3), ("d", D, "A", 2020, 4), (None, D, "A", 2020, 5)],
        "ws_id string, point_date date, freq string, fiscal_period int, x int")
    cal1 = spark.createDataFrame([("c", D, "A", 2020, "p")], "ws_id string, point_date date, freq string, fiscal_period int, c1 string")
    cal2 = spark.createDataFrame([("c", D, "A", "r"), (None, D, "A", "n")], "ws_id string, point_date date, freq string, c2 string")
    k4, k3 = ["ws_id", "point_date", "freq", "fiscal_period"], ["ws_id", "point_date", "freq"]
    want = facts.join(cal1, k4, "left").join(cal2, k3, "left")
    got = attach_periods(facts, cal1, cal2, k4, k3)
    norm = lambda df: sorted(tuple(r[c] for c in ["x", "c1", "c2"]) for r in df.collect())
    assert norm(got) == norm(want)
    assert norm(got)[1] == (2, None, "r")     # NULL fiscal period still gets its reported period


def test_year_bins_broadcast(spark):
    df = spark.createDataFrame([(1995,)], "fye_year int")
    out = attach_year_bins(df)
    assert out.collect()[0]["fye_bin"] == "1995–1999"
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_assert_unique(spark):
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    assert_unique(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])


KEYS = ["ws_id", "point_date", "freq", "fiscal_period", "cal1_55350"]


def _items(spark, rows):
    return spark.createDataFrame(
        [("c", D, "A", 2020, "m", code, v, o) for code, v, o in rows],
        "ws_id string, point_date date, freq string, fiscal_period int, cal1_55350 string, item_code int, value string, ord int")


def test_chain_multiplies_duplicates(spark):
    df = _items(spark, [(2201, '"1"', 1), (2201, '"2"', 2), (6699, '"3"', 3), (6699, '"4"', 4)])
    assert items_wide(df, [2201, 6699], "chain").count() == 4
    assert items_wide(df, [2201, 6699], "dedup", order_cols=["ord"]).count() == 1


def test_pivot_equals_chain_on_unique(spark):
    df = _items(spark, [(2201, '"1"', 1), (6699, '"3"', 3)])
    a = items_wide(df, [2201, 6699], "chain").collect()
    b = items_wide(df, [2201, 6699], "pivot").collect()
    assert sorted(map(tuple, a)) == sorted(tuple(r[c] for c in a[0].__fields__) for r in b)


def test_split_equals_chain_and_pivot_checks(spark):
    import pytest
    rows = [("a", 2201, "1"), ("a", 6699, "2"), ("b", 2201, "3"), ("b", 2201, "4"), ("b", 6699, "5"),
            ("c", 2201, "6"), (None, 2201, "7"), (None, 6699, "8")]
    df = spark.createDataFrame([(w, D, "A", 2020, "m", c, v) for w, c, v in rows],
                               "ws_id string, point_date date, freq string, fiscal_period int, cal1_55350 string, "
                               "item_code int, value string")
    got = {m: sorted(map(tuple, items_wide(df, [2201, 6699], m).collect())) for m in ("chain", "split")}
    assert got["chain"] == got["split"] and len(got["chain"]) == 3
    with pytest.raises(Exception, match="several rows"):
        items_wide(df, [2201, 6699], "pivot").collect()


def test_presence_by_row(spark):
    df = _items(spark, [(2201, '"1"', 1)])
    assert items_wide(df, [2201, 6699], "pivot").count() == 0
    assert items_wide(df, [2201, 6699], "chain").count() == 0
