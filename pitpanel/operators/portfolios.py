"""Portfolios from predictors (OP2): returns from the return index, the days on which a predictor
holds, breakpoints and groups per fiscal-year bin and country, and mean returns.

Every step is a grouped aggregate or a join on a key with a date range cut into calendar years,
so that a security, company, bin or country with a large share of the rows never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.functions import year_bin
from pitpanel.schemas import (COMPANY_COLUMN, COUNTRY_COLUMN, FYE_DATE, HOLD_FROM, PIT_DATE, PREDICTOR_COMPANY,
                              SECURITY_KEYS)

#: Cells that cut a group's values into parts for exact breakpoints.
CELLS = 32


def index_returns(prices: DataFrame, keys=SECURITY_KEYS, date_col: str = "Date", index_col: str = "RI",
                  weight_col: str = "MV") -> DataFrame:
    """(keys, date, ret, weight): the change of the return index since the security's previous day with an
    index, and the market value of that day.

    Rows without an index or a date are left out; of several rows of one security and day the
    smallest (index, market value) counts; a security's first day has no return, nor has a day
    after an index of zero. The previous day is looked for within a calendar year; the last
    day of every year is carried into the security's next year, so no window holds more than a
    security's year (366 days)."""
    keys = list(keys)
    day = (prices.where(F.col(index_col).isNotNull() & F.col(date_col).isNotNull())
           .groupBy(*keys, date_col).agg(F.min(F.struct(F.col(index_col).alias("i"), F.col(weight_col).alias("w"))).alias("p"))
           .select(*keys, F.col(date_col).alias("d"), F.year(date_col).alias("y"), "p.i", "p.w"))
    # the last day of each year, given to the next year in which the security has days
    last = day.groupBy(*keys, "y").agg(F.max(F.struct("d", "i", "w")).alias("l"))
    carried = (last.withColumn("y", F.lead("y").over(Window.partitionBy(*keys).orderBy("y")))
               .where("y IS NOT NULL").select(*keys, "l.d", "y", "l.i", "l.w", F.lit(True).alias("carried")))
    before = Window.partitionBy(*keys, "y").orderBy("d")
    return (day.withColumn("carried", F.lit(False)).unionByName(carried)
            .withColumns({"i0": F.lag("i").over(before), "w0": F.lag("w").over(before)})
            .where(~F.col("carried") & F.col("i0").isNotNull())
            .select(*keys, F.col("d").alias(date_col), (F.col("i") / F.nullif(F.col("i0"), F.lit(0.0)) - 1).alias("ret"),
                    F.col("w0").alias("weight")))


def holding_spells(predictors: DataFrame, names, hold_months: int = 12, company: str = PREDICTOR_COMPANY,
                   start: str = HOLD_FROM, known: str = PIT_DATE, fye: str = FYE_DATE) -> DataFrame:
    """(company, from_date, to_date, fye_bin, names): a company's predictors hold from their ``start`` date until
    the company's next one, for ``hold_months`` at most; ``to_date`` is the first day after.

    Of several rows with one start date the one known last counts (ties: the smallest other
    values). Rows without company or start date are left out."""
    names = list(names)
    picked = (predictors.where(F.col(company).isNotNull() & F.col(start).isNotNull())
              .groupBy(F.col(company).alias("company"), F.col(start).alias("from_date"))
              .agg(F.min(F.struct((-F.unix_date(F.coalesce(known, F.lit("0001-01-01").cast("date")))).alias("k"), F.col(fye).alias("f"),
                                  *[F.col(n).alias(f"v{i}") for i, n in enumerate(names)])).alias("r")))
    next_start = F.lead("from_date").over(Window.partitionBy("company").orderBy("from_date"))
    return picked.select(
        "company", "from_date", F.least(next_start, F.add_months("from_date", hold_months)).alias("to_date"),
        year_bin(F.year("r.f")).alias("fye_bin"), *[F.col(f"r.v{i}").alias(n) for i, n in enumerate(names)])


def held_days(returns: DataFrame, spells: DataFrame, company: str = COMPANY_COLUMN, date_col: str = "Date") -> DataFrame:
    """Returns INNER JOIN spells on the company and from_date <= day < to_date.

    Both sides carry the calendar year as a further key: a spell has one row per year that it
    touches (two for spells of up to twelve months), so a day meets the spells of one company
    and year only, and a company with many rows is split by year (and by AQE within a year)."""
    years = F.sequence(F.year("from_date"), F.year(F.date_sub("to_date", 1)))
    cut = spells.where("to_date > from_date").withColumn("year", F.explode(years))
    days = returns.withColumn("year", F.year(date_col))
    on = (days[company] == cut["company"]) & (days["year"] == cut["year"])
    within = (days[date_col] >= cut["from_date"]) & (days[date_col] < cut["to_date"])
    return days.join(cut, on & within).drop(days["year"]).drop(cut["year"]).drop(cut["company"])


def long_predictors(wide: DataFrame, names, ids) -> DataFrame:
    """(ids, predictor, value): one row per predictor and non-NULL value."""
    return wide.unpivot(list(ids), list(names), "predictor", "value").where(F.col("value").isNotNull())


def breakpoints(values: DataFrame, groups, n_groups: int = 5, value_col: str = "value", cells: int = CELLS) -> DataFrame:
    """(groups, n, breaks): exact breakpoints of each group: break i is the value of rank ceil(i * n / n_groups)
    among the group's n non-NULL values, i from 1 to n_groups - 1.

    Values are counted per distinct value first (map-side combined). Approximate cut points, a
    mergeable sketch, split each group into ``cells`` parts whose exact counts tell which part
    holds which rank; only those parts are ordered, one window per part. So a group's size is
    spread over ``cells`` tasks, and what the approximation misses only changes the parts' sizes."""
    groups = list(groups)
    hist = values.where(F.col(value_col).isNotNull()).groupBy(*groups, F.col(value_col).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    cuts = hist.groupBy(*groups).agg(F.percentile_approx("v", [i / cells for i in range(1, cells)], F.lit(10 * cells)).alias("cuts"))
    same = [F.col(f"h.{g}").eqNullSafe(F.col(f"k.{g}")) for g in groups]
    placed = (hist.alias("h").join(cuts.alias("k"), same)
              .select(*[F.col(f"h.{g}").alias(g) for g in groups], "v", "c",
                      F.size(F.filter("cuts", lambda x: x < F.col("v"))).alias("cell")))
    per = placed.groupBy(*groups, "cell").agg(F.sum("c").alias("m"))
    whole = Window.partitionBy(*groups)
    per = per.withColumns({"n": F.sum("m").over(whole), "upto": F.sum("m").over(whole.orderBy("cell"))})
    # ranks as whole numbers: ceil(i * n / g) = (i * n + g - 1) div g
    rank = F.transform(F.sequence(F.lit(1), F.lit(n_groups - 1)),
                       lambda i: F.floor((i * F.col("n") + (n_groups - 1)) / n_groups))
    wanted = per.select(*groups, "cell", "n", (F.col("upto") - F.col("m")).alias("below"), "upto",
                        F.posexplode(rank).alias("i", "rank"))
    wanted = wanted.where((F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("upto")))
    parts = wanted.select(*groups, "cell", "below").distinct()
    same = [F.col(f"p.{g}").eqNullSafe(F.col(f"w.{g}")) for g in groups] + [F.col("p.cell") == F.col("w.cell")]
    inside = (placed.alias("p").join(parts.alias("w"), same)
              .select(*[F.col(f"p.{g}").alias(g) for g in groups], F.col("p.cell").alias("cell"), "v", "c", "below"))
    run = Window.partitionBy(*groups, "cell").orderBy("v")
    inside = inside.withColumn("upto", F.col("below") + F.sum("c").over(run))
    same = [F.col(f"p.{g}").eqNullSafe(F.col(f"w.{g}")) for g in groups] + [
        F.col("p.cell") == F.col("w.cell"), F.col("p.upto") >= F.col("w.rank"), F.col("p.upto") - F.col("p.c") < F.col("w.rank")]
    found = (inside.alias("p").join(wanted.alias("w"), same)
             .select(*[F.col(f"p.{g}").alias(g) for g in groups], "n", "i", "v"))
    return (found.groupBy(*groups, "n").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("b"))     # n_groups - 1 of them
            .select(*groups, "n", F.col("b.v").alias("breaks")))


def assign_groups(values: DataFrame, breaks: DataFrame, groups, value_col: str = "value") -> DataFrame:
    """Adds ``portfolio``: 1 + the number of the group's breakpoints below the value (1 to n_groups)."""
    groups = list(groups)
    same = [F.col(f"x.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups]
    return (values.alias("x").join(breaks.alias("b"), same)
            .select("x.*", (F.size(F.filter("b.breaks", lambda b: b < F.col(f"x.{value_col}"))) + 1).alias("portfolio")))


def portfolio_means(held: DataFrame, by) -> DataFrame:
    """Per ``by``: days held (n), the equal-weighted mean return, and the mean weighted by the earlier
    day's market value over the days that have a positive one (NULL without any)."""
    w = F.when((F.col("weight") > 0) & F.col("ret").isNotNull(), F.col("weight"))
    return held.groupBy(*by).agg(
        F.count("ret").alias("n"), F.avg("ret").alias("ew_return"),
        (F.sum(w * F.col("ret")) / F.nullif(F.sum(w), F.lit(0.0))).alias("vw_return"))
