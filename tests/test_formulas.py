import pytest
from pyspark.sql import functions as F

from pitpanel.operators.formulas import ACC, Predictor, apply_registry, predictor_columns


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.5, 0.1, 0.2, 0.0), (1.0, 0.5, 0.1, 0.2, 2.0)],
                               "CA double, CL double, Cash double, STD double, TA double")
    out, done, skipped = apply_registry(df, (ACC,))
    vals = [r["Acc"] for r in out.collect()]
    assert vals[0] is None and abs(vals[1] - 0.3) < 1e-12
    assert done == ["Acc"] and skipped == []
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_missing_input_skipped(spark):
    df = spark.createDataFrame([(1.0,)], "TA double")
    with pytest.warns(UserWarning):
        out, done, skipped = apply_registry(df, (Predictor("X", "SGA / TA", (1101, 6699)),))
    assert skipped == ["X"] and "X" not in out.columns


def test_formula_inputs_include_names_used():
    p = Predictor("Acc", "(CA - CL - Cash + STD) / TA", (2201, 3101, 2003, 3051))
    assert 6699 in p.codes()


def test_dependent_formula(spark):
    df = spark.createDataFrame([(1.0, 0.5, 0.1, 0.2, 2.0)], "CA double, CL double, Cash double, STD double, TA double")
    out, done, _ = apply_registry(df, (ACC, Predictor("AccPct", "Acc * 100")))
    assert abs(out.collect()[0]["AccPct"] - 30.0) < 1e-9


def test_predictor_columns(spark):
    df = spark.createDataFrame([("a", 1.0, 2, 3)], "ws_id string, Acc double, n bigint, i int")
    assert predictor_columns(df) == ["Acc", "n"]


def test_profile_and_shape(spark):
    from pitpanel.operators.profile import column_profile, shape, top_values, value_counts
    from pitpanel.plans.jobs import profile
    df = spark.createDataFrame([("a", None, 1.5), ("a", "x", 1.5), (None, "x", None)], "p string, q string, `r.s` double")
    prof, top = profile(df, df.columns)
    want = {"p": (1, 1), "q": (1, 1), "r.s": (1, 1)}
    assert {r["column_name"]: (r["null_count"], r["unique_count"]) for r in prof.collect()} == want
    assert {r["column_name"]: (r["null_count"], r["unique_count"]) for r in column_profile(df, approx=True).collect()} == want
    assert sorted(map(tuple, top.collect()), key=repr) == [("p", "a", 2), ("p", None, 1), ("q", "x", 2), ("q", None, 1),
                                                          ("r.s", "1.5", 2), ("r.s", None, 1)]
    assert [tuple(r) for r in top_values(df, "q").collect()] == [("x", 2), (None, 1)]
    assert sorted(tuple(r) for r in value_counts(df, "p").collect()) == [("a", 2)]
    s = shape(df)
    assert s["rows"] == 3 and s["columns"] == ["p", "q", "r.s"]


def test_profile_of_an_empty_table_and_its_plan(spark):
    from pitpanel.operators.profile import column_profile, histogram_top, value_histogram
    df = spark.createDataFrame([], "p string, q int")
    assert sorted(map(tuple, column_profile(df).collect())) == [("p", 0, 0), ("q", 0, 0)]
    assert histogram_top(value_histogram(df)).count() == 0
    plan = column_profile(spark.range(10).selectExpr("id", "id % 3 AS b"))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" in plan


def test_divisors_are_null_on_zero(spark):
    from pitpanel.operators.formulas import null_on_zero
    assert null_on_zero("a / (b - c / d) % -abs(x) + 1").replace(" ", "") == \
        "a/nullif((b-c/nullif(d,0)),0)%nullif(-abs(x),0)+1"
    old = spark.conf.get("spark.sql.ansi.enabled")
    df = spark.createDataFrame([(1.0, 0.0), (6.0, 3.0)], "CA double, TA double")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        out, _, _ = apply_registry(df, (Predictor("R", "CA / TA / 2"),))
        assert sorted(out.select("CA", "R").collect()) == [(1.0, None), (6.0, 1.0)]
        assert spark.conf.get("spark.sql.ansi.enabled") == ansi
    spark.conf.set("spark.sql.ansi.enabled", old)


def test_case_text_and_nested_divisors(spark):
    from pitpanel.operators.formulas import names_used, null_on_zero
    for formula, want in (
            ("a / CASE WHEN b > 0 THEN b / c ELSE 0 END + 1", "a / nullif(CASE WHEN b > 0 THEN b / nullif(c, 0) ELSE 0 END, 0) + 1"),
            ("concat('x/y', z)", "concat('x/y', z)"),
            ("a / coalesce(b, c)[0].d::double * 2", "a / nullif(coalesce(b, c)[0].d::double, 0) * 2"),
            ("a / `b/c` -- a / b", "a / nullif(`b/c`, 0) -- a / b"),
            ("a div b % 3", "a div nullif(b, 0) % nullif(3, 0)"),
            ("a / /* x/y */ 1.5e3", "a / nullif(/* x/y */ 1.5e3, 0)")):
        assert null_on_zero(formula) == want
    assert names_used("CA / `T A` + 'TL' -- BE") == {"CA", "T A"}
    with pytest.raises(ValueError):
        null_on_zero("a / ")
    with pytest.raises(ValueError):
        null_on_zero("a / (b")
    df = spark.createDataFrame([(6.0, 0.0), (6.0, 3.0)], "CA double, CL double")
    out, _, _ = apply_registry(df, (Predictor("X", "CA / CASE WHEN CL > 0 THEN CL / 3 ELSE CL END"),
                                    Predictor("Y", "length(concat('x/y', CA / CL))")))
    assert [(r.X, r.Y) for r in out.orderBy("CL").collect()] == [(None, None), (6.0, 6.0)]


def test_previous_year_inputs(spark):
    """Gaps, restatements, repeated rows and NULL keys."""
    from pitpanel.operators.formulas import PUBLISHED_REGISTRY, with_previous
    rows = [("C1", "2001-03-01", "A", 2000, 100.0), ("C1", "2002-03-01", "A", 2001, 110.0),
            ("C1", "2002-09-01", "A", 2000, 999.0),                                # 2000 restated after 2001 was known
            ("C1", "2003-03-01", "A", 2002, 120.0), ("C1", "2003-03-01", "A", 2002, 121.0),     # a repeated period
            ("C1", "2005-03-01", "A", 2004, 150.0),                                # 2003 is missing
            ("C1", "2002-10-01", "A", 2001, 111.0),                                # 2001 restated: sees the restated 2000
            ("C1", "2002-03-01", "Q", 2001, 7.0), ("C2", "2000-01-01", "A", 2001, 5.0), ("C2", "2001-01-01", "A", 2000, 4.0),
            (None, "2001-01-01", "A", 2001, 1.0), ("C1", None, "A", 2001, 2.0)]
    df = spark.createDataFrame([(a, b, c, d, e) for a, b, c, d, e in rows],
                               "ws_id string, point_date string, freq string, fiscal_period long, TA double") \
        .withColumn("point_date", F.to_date("point_date"))
    got = {(r.ws_id, str(r.point_date), r.freq, r.TA): r.prev_TA for r in with_previous(df, ["TA"]).collect()}
    assert len(got) == len(rows)
    assert got == {("C1", "2001-03-01", "A", 100.0): None, ("C1", "2002-03-01", "A", 110.0): 100.0,
                   ("C1", "2002-09-01", "A", 999.0): None, ("C1", "2003-03-01", "A", 120.0): 111.0,
                   ("C1", "2003-03-01", "A", 121.0): 111.0, ("C1", "2005-03-01", "A", 150.0): None,
                   ("C1", "2002-10-01", "A", 111.0): 999.0, ("C1", "2002-03-01", "Q", 7.0): None,
                   ("C2", "2000-01-01", "A", 5.0): None, ("C2", "2001-01-01", "A", 4.0): None,
                   (None, "2001-01-01", "A", 1.0): None, ("C1", "None", "A", 2.0): None}
    out, done, skipped = apply_registry(df, (Predictor("G", "(TA - prev_TA) / prev_TA"), Predictor("H", "prev_TA + prev_SGA")))
    assert done == ["G"] and skipped == ["H"] and "prev_TA" not in out.columns
    assert {r.G for r in out.collect() if r.TA == 110.0} == {0.1}
    assert len(PUBLISHED_REGISTRY) == 28 and len({p.name for p in PUBLISHED_REGISTRY}) == 28


def test_published_registry_computes(spark):
    from pitpanel.operators.formulas import PUBLISHED_REGISTRY
    from pitpanel.schemas import ITEM_NAMES
    names = list(ITEM_NAMES.values())
    df = spark.createDataFrame([("C1", "A", y, d, *[float(y - 1990 + i) for i in range(len(names))]) for y, d in ((2000, 1), (2001, 2))],
                               "ws_id string, freq string, fiscal_period long, point_date int, " + ", ".join(f"{n} double" for n in names))
    out, done, skipped = apply_registry(df, PUBLISHED_REGISTRY)
    assert skipped == [] and len(done) == 28
    last = out.where("fiscal_period = 2001").first().asDict()
    assert all(last[n] is not None for n in done)
