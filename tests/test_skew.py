"""A key holding a third of the rows: joins must split it (AQE skew join),
aggregations must combine it map-side."""

import contextlib
import datetime as dt

from pyspark.sql import functions as F

from pitpanel.operators.clean import latest_per_key
from pitpanel.operators.joins import attach_periods, join_legs
from pitpanel.operators.reshape import pivot_first


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def skewed_facts(spark, n=30000):
    # one third of the rows on company "HOT"
    return (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string"))).alias("ws_id"),
        # the hot company-period is one full key; the other rows vary in every key part
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("int")).alias("point_date"),
        F.when((F.col("id") % 3 == 0) | (F.col("id") % 2 == 0), "A").otherwise("B").alias("freq"),
        F.when(F.col("id") % 3 == 0, 2020).otherwise(2015 + F.col("id") % 5).cast("bigint").alias("fiscal_period"),
        F.col("id").alias("x")))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_period_join_splits_hot_key(spark):
    with conf(spark, **SKEW):
        facts = skewed_facts(spark)
        keys = facts.select("ws_id", "point_date", "freq", "fiscal_period").distinct()
        cal1 = keys.withColumn("c1", F.lit("p"))
        cal2 = keys.drop("fiscal_period").distinct().withColumn("c2", F.lit("r"))
        out = attach_periods(facts, cal1, cal2)
        rows, plan = final_plan(out)
        assert len(rows) == 30000 and all(r["c1"] == "p" and r["c2"] == "r" for r in rows)
        assert "skew=true" in plan


def test_leg_join_splits_hot_key(spark):
    with conf(spark, **SKEW):
        d = dt.date(2020, 1, 1)
        ri = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("DSCode"),
            F.date_add(F.lit(d), (F.col("id") % 5).cast("int")).alias("Date"), F.lit("LC").alias("Currency"),
            F.lit("1").alias("suffix"), F.col("id").cast("double").alias("RI"))
        mv = ri.select("DSCode", "Date", "Currency", "suffix").distinct().withColumn("MV", F.lit(1.0))
        rows, plan = final_plan(join_legs(ri, mv))
        assert len(rows) == 30000
        assert "skew=true" in plan


def test_hot_key_aggregates_map_side(spark):
    facts = skewed_facts(spark).withColumn("item_code", F.lit(1)).withColumn("value", F.col("x").cast("string"))
    p = pivot_first(facts, ["ws_id"], [1], "c_", order_col="x")
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan                 # combined before the shuffle
    hot = p.where(F.col("ws_id") == "HOT").collect()[0]
    assert hot["c_1"] == "0"
    latest = latest_per_key(facts, ["ws_id"], "point_date", ["x"])
    assert "partial_min" in latest._jdf.queryExecution().executedPlan().toString()
