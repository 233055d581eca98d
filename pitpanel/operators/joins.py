"""Equi-joins of the pipeline (JN1-JN8). Inner and left only; duplicate keys
fan out exactly as a relational join does, NULL keys never match.

Join strategy is left to Catalyst + AQE: a side is broadcast only when its
size measured at run time is under ``spark.sql.autoBroadcastJoinThreshold``
(or, for fixed lookups, when its size is fixed by construction); otherwise
a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.functions import year_bins_frame
from pitpanel.schemas import PERIOD_KEYS, PRICE_KEYS, REPORTED_KEYS


def assert_unique(df: DataFrame, keys) -> None:
    """Raise when ``keys`` is not unique (one aggregation job; only the
    first offending key comes back to the driver)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"key {list(keys)} is not unique, e.g. {dup[0].asDict()}")


def join_legs(ri: DataFrame, mv: DataFrame, keys=PRICE_KEYS, pair_cols=("suffix",), pairs: DataFrame | None = None) -> DataFrame:
    """Return leg LEFT JOIN market-value leg (JN1 with JN2).

    Legs are paired by ``pair_cols`` (the file-name suffix) and currency: a
    return row whose (suffix, currency) has no market-value leg at all is
    dropped (semi join on the distinct pairs, a tiny side), the rest get
    MV or NULL. Market-value-only rows are not kept. ``pairs`` are the (suffix,
    currency) with both legs, known from the files' names; without it they are the ones among the rows of ``mv``.
    """
    pair = list(pair_cols) + ["Currency"]
    pairs = mv.select(*pair).distinct() if pairs is None else pairs.select(*pair)
    on = list(keys) + list(pair_cols)
    mv_vals = mv.select(*on, *[c for c in mv.columns if c not in on])
    return (ri.join(pairs, pair, "left_semi")
            .join(mv_vals, on, "left"))


def attach_matching(panel: DataFrame, matching: DataFrame, cols=("GEOGC", "WC06105"),
                    left_key: str = "DSCode", right_key: str = "DSCD") -> DataFrame:
    """Price panel LEFT JOIN matching table on security code (JN3).

    The right key is dropped; several matching rows per code fan out.
    """
    m = matching.select(F.col(right_key).alias(left_key), *cols)
    return panel.join(m, left_key, "left")


def attach_periods(facts: DataFrame, cal1: DataFrame, cal2: DataFrame,
                   keys4=PERIOD_KEYS, keys3=REPORTED_KEYS) -> DataFrame:
    """facts LEFT JOIN cal1 ON keys4 LEFT JOIN cal2 ON keys3 (JN4, JN5).

    The two lookups are first resolved once per distinct company-period of
    the facts (a small, pre-aggregated spine) and the facts are then joined
    to that spine once: the fact table — the large input — is shuffled once
    instead of twice. The result is the same as the two-join form: a fact
    gets (matches in cal1) x (matches in cal2) rows either way (one row with
    NULLs when nothing matches), and the spine join matches the keys only
    cal1 uses null-safely, so a fact with a NULL fiscal period still gets
    its reported period.
    """
    keys4, keys3 = list(keys4), list(keys3)
    spine = (facts.select(*keys4).distinct()
             .join(cal1, keys4, "left")
             .join(cal2, keys3, "left"))
    # Only keys that cal2 does not use need NULL-safe matching: a NULL in a
    # shared key matches neither table, so a plain miss gives the same NULLs.
    cond = reduce(lambda a, b: a & b,
                  [facts[k] == spine[k] if k in keys3 else facts[k].eqNullSafe(spine[k]) for k in keys4])
    extra = [c for c in spine.columns if c not in keys4]
    return facts.join(spine, cond, "left").select(facts["*"], *[spine[c] for c in extra])


def attach_year_bins(df: DataFrame, year_col: str = "fye_year") -> DataFrame:
    """LEFT JOIN to the 60-row year -> bin lookup (JN6), broadcast: its size
    is fixed by construction."""
    bins = year_bins_frame(df.sparkSession)
    if year_col != "fye_year":
        bins = bins.withColumnRenamed("fye_year", year_col)
    return df.join(F.broadcast(bins), year_col, "left")


def attach_item(panel: DataFrame, item_rows: DataFrame, name: str,
                panel_keys=("WC06105", "Date"), item_keys=("ws_id", "point_date"),
                value_col: str = "value") -> DataFrame:
    """Panel LEFT JOIN one item's values on (company, exact date) (JN8).

    Duplicate item rows per key fan out; the value is renamed ``name``.
    """
    r = item_rows.select(*[F.col(i).alias(p) for p, i in zip(panel_keys, item_keys)],
                         F.col(value_col).alias(name))
    return panel.join(r, list(panel_keys), "left")
