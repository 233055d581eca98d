import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitpanel.operators.stats import (availability_panel, distribution_panel, nearest_quantiles,
                                      sign_counts)


def frame(spark, values, group="g"):
    return spark.createDataFrame([(group, v) for v in values], "g string, v bigint")


def test_nearest_and_median(spark):
    r = distribution_panel(frame(spark, [1, 2, 3, 4, 10, 20]), "g", "v").collect()[0]
    assert r["90thPct"] == 20.0          # rank round(5 * 0.9) + 1 = 6
    assert r["10thPct"] == 2.0           # rank round(5 * 0.1) + 1 = 2 (0.5 rounds up)
    assert r["Median"] == 3.5
    assert r["Mean"] == 6.7


def test_std_of_one_value_is_null(spark):
    r = distribution_panel(frame(spark, [1]), "g", "v").collect()[0]
    assert r["StdDev"] is None and r["Median"] == 1.0


def test_all_null_group(spark):
    df = spark.createDataFrame([("g", None)], "g string, v bigint")
    r = availability_panel(df, "g", "v").collect()[0]
    assert (r["N"], r["FF92_not_available"], r["Data_available_by_FF92"]) == (1, 0, 0)


def test_null_group_kept_and_first(spark):
    df = spark.createDataFrame([(None, 1), ("a", -1), ("a", 2)], "g string, v bigint")
    rows = availability_panel(df, "g", "v").collect()
    assert rows[0]["g"] is None and rows[1]["N"] == 2


def test_sign_counts_partition_rows(spark):
    df = spark.createDataFrame([(v,) for v in [-3, 0, 5, None]], "v bigint")
    r = sign_counts(df, "v").collect()[0]
    assert (r[0], r[1]) == (2, 1)        # NULL in neither


def brute_nearest(vals, q):
    s = sorted(v for v in vals if v is not None)
    if not s:
        return None
    import decimal
    k = int(decimal.Decimal(repr((len(s) - 1) * q)).quantize(0, decimal.ROUND_HALF_UP)) + 1
    return float(s[k - 1])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-400, 400)), min_size=1, max_size=60))
def test_histogram_quantile_equals_rank(spark, vals):
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v bigint")
    got = nearest_quantiles(df, "g", "v").collect()
    r = got[0]                              # an all-NULL group is kept, with NULL quantiles
    assert r["10thPct"] == brute_nearest(vals, 0.1)
    assert r["90thPct"] == brute_nearest(vals, 0.9)


def test_linear_and_other_interpolations(spark):
    df = frame(spark, [1, 2, 3, 4, 10, 20])
    r = distribution_panel(df, "g", "v", interpolation="linear").collect()[0]
    assert r["10thPct"] == 1.5 and r["Median"] == 3.5
    q = nearest_quantiles(df, "g", "v", (0.5,), ("m",), "linear").collect()[0]
    assert q["m"] == 3.5
    for interp, want in (("lower", 3.0), ("higher", 4.0), ("midpoint", 3.5), ("nearest", 4.0)):
        assert nearest_quantiles(df, "g", "v", (0.5,), ("m",), interp).collect()[0]["m"] == want


def test_after_before_null_add_up(spark):
    from pitpanel.plans import fixtures as fx
    from pitpanel.plans import lag
    from pitpanel.plans.catalog import _merged
    feats = lag.lag_features(_merged(fx.Tables(spark, "/root/testdata/sf0.001")))
    c = lag.lag_counts(feats).collect()[0]
    nulls = feats.where(F.col("diff_to_ff92").isNull()).count()
    assert c["n_on_or_before_ff92"] + c["n_after_ff92"] + nulls == feats.count()
    panel = {r["fye_bin"]: r for r in lag.panel_c(feats).collect()}
    assert sum(r["N"] for r in panel.values()) == feats.count()
