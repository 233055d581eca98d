from pitpanel.operators.clean import (dedup_rows, drop_if_present, drop_missing_period, keep_recent,
                                      latest_per_key)


def test_drop_missing_period_three_valued(spark):
    rows = [("0", "0"), ("0", "1"), (None, "0"), (None, "1"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = sorted(drop_missing_period(df, "a", "b").collect(), key=str)
    assert [tuple(r) for r in got] == sorted([("0", "1"), (None, "1")], key=str)


def test_keep_recent_null_drops(spark):
    df = spark.createDataFrame([("1", "1"), ("1", None), ("1", "2")], "a string, b string")
    assert keep_recent(df, "a", "b").count() == 1


def test_latest_nulls_last_ties_by_payload(spark):
    import datetime as dt
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("k", d, "q"), ("k", d, "p"), ("k", None, "r")], "k string, t date, p string")
    r = latest_per_key(df, ["k"], "t").collect()
    assert len(r) == 1 and r[0]["p"] == "p"


def test_latest_prefers_recent(spark):
    import datetime as dt
    df = spark.createDataFrame([("k", dt.date(2020, 1, 1), "old"), ("k", dt.date(2021, 1, 1), "new"),
                                ("k", None, "none")], "k string, t date, p string")
    assert latest_per_key(df, ["k"], "t").collect()[0]["p"] == "new"


def test_null_dedup_keys_one_group(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a")], "k string, p string")
    r = dedup_rows(df, ["k"]).collect()
    assert len(r) == 1 and r[0]["p"] == "a"


def test_drop_absent_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert drop_if_present(df, ["nope"]).columns == ["a"]


def test_dedup_plan_is_an_aggregate(spark):
    df = spark.createDataFrame([("k", 1)], "k string, v int")
    plan = dedup_rows(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan and "Window" not in plan


def test_period_filter_partitions_input(spark):
    """FL1 keeps exactly the rows whose condition is TRUE; the rest are the dropped ones."""
    from pyspark.sql import functions as F
    vals = ["0", "1", None]
    df = spark.createDataFrame([(a, b) for a in vals for b in vals], "a string, b string")
    kept = drop_missing_period(df, "a", "b")
    dropped = df.where(~F.coalesce(~((F.col("a") == "0") & (F.col("b") == "0")), F.lit(False)))
    assert kept.count() + dropped.count() == df.count()
    assert kept.unionByName(dropped).distinct().count() == df.distinct().count()
