"""DuckDB SQL for every catalogue query: an independent, brute-force
formulation (window ranks instead of histograms, plain joins instead of the
period spine) used only to check the Spark plans."""

from __future__ import annotations

_BIN = """CASE WHEN fye_year IS NULL OR fye_year < 1970 OR fye_year > 2029 THEN NULL
 WHEN fye_year BETWEEN 1990 AND 1994 THEN '1990–1994'
 WHEN fye_year BETWEEN 1995 AND 1999 THEN '1995–1999'
 WHEN fye_year BETWEEN 2000 AND 2004 THEN '2000–2004'
 WHEN fye_year BETWEEN 2005 AND 2009 THEN '2005–2009'
 WHEN fye_year BETWEEN 2010 AND 2014 THEN '2010–2014'
 WHEN fye_year BETWEEN 2015 AND 2018 THEN '2015–2018'
 ELSE 'Other' END"""

_ACC_ITEMS = [(2003, "Cash"), (2201, "CA"), (3051, "STD"), (3101, "CL"), (6699, "TA")]


def _item_part(src, code, name):
    return (f"(SELECT ws_id, point_date, freq, fiscal_period, cal1_55350, "
            f"CAST(replace(value, '\"', '') AS DOUBLE) AS {name} FROM {src} WHERE item_code = {code})")


def _chain(src):
    parts = [f"{_item_part(src, c, n)} x{n}" for c, n in _ACC_ITEMS]
    return (f"SELECT * FROM {parts[0]} " +
            " ".join(f"JOIN {p} USING (ws_id, point_date, freq, fiscal_period, cal1_55350)"
                     for p in parts[1:]))


def _pivot(src):
    num = "CAST(replace(value, '\"', '') AS DOUBLE)"
    cols = ", ".join(f"max({num}) FILTER (WHERE item_code = {c}) AS {n}" for c, n in _ACC_ITEMS)
    return (f"SELECT ws_id, point_date, freq, fiscal_period, cal1_55350, {cols} FROM {src} "
            f"WHERE item_code IN (2003, 2201, 3051, 3101, 6699) AND ws_id IS NOT NULL "
            f"AND point_date IS NOT NULL AND freq IS NOT NULL AND fiscal_period IS NOT NULL "
            f"AND cal1_55350 IS NOT NULL "
            f"GROUP BY ws_id, point_date, freq, fiscal_period, cal1_55350 "
            f"HAVING count(DISTINCT item_code) = 5")


def _dates(src):
    return (f"SELECT *, CAST(fye_date + INTERVAL 6 MONTH AS DATE) AS ff92_date FROM ("
            f"SELECT *, CAST(strptime(regexp_replace(replace(cal1_55350, '\"', ''), '^d', ''), '%Y%m%d') AS DATE) AS fye_date, "
            f"CAST(point_date AS DATE) AS pit_date FROM ({src}) s0) s1")


def _price_leg(name, is_mv):
    mv = "coalesce(event_type IN ('click', 'view'), false)"
    suffix = "CASE WHEN user_id % 3 = 2 AND user_id % 2 = 1 THEN 3 ELSE user_id % 3 END" if is_mv else "user_id % 3"
    return (f"SELECT 'U' || CAST(user_id AS VARCHAR) AS DSCode, CAST(ts AS DATE) AS Date, "
            f"CASE WHEN user_id % 2 = 0 THEN 'LC' ELSE 'USD' END AS Currency, {suffix} AS suffix, "
            f"max(value) AS {name} FROM events WHERE {'' if is_mv else 'NOT '}{mv} "
            f"GROUP BY user_id, CAST(ts AS DATE)")


CTES = {
    "fx_period": ([], """SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ws_id,
  CAST(fye + CAST((o_orderkey * 37) % 400 AS INTEGER) AS DATE) AS point_date, o_orderstatus AS freq,
  CAST(year(fye) AS BIGINT) AS fiscal_period, fye, o_orderkey AS ord
  FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) + CAST(((o_custkey % 5) * 6 - 6) * 365 AS INTEGER) AS DATE) AS fye FROM orders) t"""),
    "fx_facts": (["fx_period"], """SELECT ws_id, point_date, freq, fiscal_period,
  CAST(CASE l_linenumber WHEN 1 THEN 2201 WHEN 2 THEN 3101 WHEN 3 THEN 2003 WHEN 4 THEN 3051
       WHEN 5 THEN 6699 WHEN 6 THEN 5490 ELSE 7240 END AS BIGINT) AS item_code,
  '"' || CAST(l_extendedprice AS VARCHAR) || '"' AS value, ord, l_partkey, l_suppkey
  FROM lineitem JOIN fx_period ON l_orderkey = ord"""),
    "fx_calendar": (["fx_period"], """SELECT ws_id, point_date, freq, fiscal_period, CAST(item_code AS BIGINT) AS item_code,
  CASE item_code WHEN 55350 THEN '"d' || CAST(year(fye) * 10000 + month(fye) * 100 + day(fye) AS VARCHAR) || '"'
       WHEN 55352 THEN '12' WHEN 55555 THEN CAST(fiscal_period AS VARCHAR) ELSE 'x' END AS value, ord
  FROM (SELECT *, unnest([55350, 55352, 55555, 57034]) AS item_code FROM
  (SELECT * REPLACE (fiscal_period + CASE WHEN ord % 50 = 0 THEN 1 ELSE 0 END AS fiscal_period) FROM fx_period) p) v"""),
    "fx_reported": (["fx_period"], """SELECT ws_id, point_date, freq, CAST(item_code AS BIGINT) AS item_code,
  CASE WHEN ord % 10 = 0 THEN '0' WHEN item_code = 55558 THEN '1' WHEN ord % 4 = 0 THEN '1900'
       ELSE CAST(fiscal_period AS VARCHAR) END AS value, ord
  FROM (SELECT *, unnest([55558, 55559]) AS item_code FROM
  (SELECT * REPLACE (CASE WHEN ord % 33 = 0 THEN 'R' ELSE freq END AS freq) FROM fx_period) p) v"""),
    "cal1": (["fx_calendar"], """SELECT ws_id, point_date, freq, fiscal_period,
  arg_min_null(value, ord) FILTER (WHERE item_code = 55350) AS cal1_55350,
  arg_min_null(value, ord) FILTER (WHERE item_code = 55352) AS cal1_55352,
  arg_min_null(value, ord) FILTER (WHERE item_code = 55555) AS cal1_55555,
  arg_min_null(value, ord) FILTER (WHERE item_code = 57034) AS cal1_57034
  FROM fx_calendar GROUP BY ws_id, point_date, freq, fiscal_period"""),
    "cal2": (["fx_reported"], """SELECT ws_id, point_date, freq,
  arg_min_null(value, ord) FILTER (WHERE item_code = 55558) AS cal2_55558,
  arg_min_null(value, ord) FILTER (WHERE item_code = 55559) AS cal2_55559
  FROM fx_reported GROUP BY ws_id, point_date, freq"""),
    "merged": (["fx_facts", "cal1", "cal2"], """SELECT f.*, cal1_55350, cal1_55352, cal1_55555, cal1_57034, cal2_55558, cal2_55559
  FROM fx_facts f
  LEFT JOIN cal1 c ON f.ws_id = c.ws_id AND f.point_date = c.point_date AND f.freq = c.freq AND f.fiscal_period = c.fiscal_period
  LEFT JOIN cal2 r ON f.ws_id = r.ws_id AND f.point_date = r.point_date AND f.freq = r.freq"""),
    "filtered": (["merged"], "SELECT * FROM merged WHERE NOT (cal2_55558 = '0' AND cal2_55559 = '0')"),
    "final": (["filtered"], "SELECT * FROM filtered WHERE cal1_55555 = cal2_55559"),
    "final_no_cols": (["final"], "SELECT * EXCLUDE (cal1_57034, cal1_55352, cal1_55555, cal2_55558) FROM final"),
    "final_dedup": (["final"], """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY ws_id, point_date, freq, fiscal_period, cal1_55350, item_code ORDER BY value, l_partkey, l_suppkey) AS rn
  FROM final) t WHERE rn = 1"""),
    "features": (["final_no_cols"], f"""SELECT *, {_BIN} AS fye_bin FROM (
  SELECT *, CAST(pit_date - fye_date AS BIGINT) AS diff_to_fye, CAST(pit_date - ff92_date AS BIGINT) AS diff_to_ff92,
  CAST(year(fye_date) AS INTEGER) AS fye_year FROM ({_dates('SELECT * FROM final_no_cols')}) d) b"""),
    "features_merged": (["merged"], f"""SELECT *, {_BIN} AS fye_bin FROM (
  SELECT *, CAST(pit_date - fye_date AS BIGINT) AS diff_to_fye, CAST(pit_date - ff92_date AS BIGINT) AS diff_to_ff92,
  CAST(year(fye_date) AS INTEGER) AS fye_year FROM ({_dates('SELECT * FROM merged')}) d) b"""),
    "fx_price_ri": ([], _price_leg("RI", False)),
    "fx_price_mv": ([], _price_leg("MV", True)),
    "price_join_v": (["fx_price_ri", "fx_price_mv"], """SELECT r.DSCode, r.Date, r.Currency, r.RI, m.MV FROM fx_price_ri r
  JOIN (SELECT DISTINCT suffix, Currency FROM fx_price_mv) p ON r.suffix = p.suffix AND r.Currency = p.Currency
  LEFT JOIN fx_price_mv m ON r.DSCode = m.DSCode AND r.Date = m.Date AND r.Currency = m.Currency AND r.suffix = m.suffix"""),
    "fx_match": ([], """SELECT 'U' || CAST(o_custkey AS VARCHAR) AS DSCD,
  'C' || CAST(o_custkey AS VARCHAR) || '-' || substr(o_orderpriority, 1, 1) AS WC06105, c_nationkey AS GEOGC,
  o_orderkey AS ISIN,
  lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '/' || CAST(year(o_orderdate) AS VARCHAR) AS TIME,
  CAST(o_orderdate AS DATE) AS t
  FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "match_latest_v": (["fx_match"], """SELECT DSCD, WC06105, GEOGC, ISIN, TIME FROM (SELECT *, row_number() OVER (
  PARTITION BY DSCD, WC06105 ORDER BY t DESC NULLS LAST, ISIN) AS rn FROM fx_match) x WHERE rn = 1"""),
    "days": ([], """SELECT d, CASE WHEN day(d) = 15 THEN strftime(d, '%d/%m/%Y') || '_duplicated_0'
    WHEN day(d) = 30 THEN 'Unnamed: ' || strftime(d, '%Y%m') ELSE strftime(d, '%d/%m/%Y') END AS h
  FROM (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
        FROM events) t"""),
    "cells": (["fx_price_ri", "fx_price_mv"], """SELECT *, CASE WHEN day(Date) = 2 AND CAST(substr(DSCode, 2) AS BIGINT) % 7 = 0
    THEN 'NA' ELSE CAST(v AS VARCHAR) END AS cell
  FROM (SELECT DSCode, 'RI' AS leg, Date, RI AS v FROM fx_price_ri
        UNION ALL SELECT DSCode, 'MV', Date, MV FROM fx_price_mv) c"""),
    "wide_long": (["fx_price_ri", "fx_price_mv", "days", "cells"], """SELECT s.DSCode, s.Currency, s.leg, s.h AS Date, c.cell AS Value
  FROM (SELECT *, day.d AS d, day.h AS h FROM (SELECT *, unnest((SELECT list(days) FROM days)) AS day
          FROM (SELECT DISTINCT DSCode, Currency, 'RI' AS leg FROM fx_price_ri
                UNION ALL SELECT DISTINCT DSCode, Currency, 'MV' FROM fx_price_mv) x) y) s
  LEFT JOIN cells c ON c.DSCode = s.DSCode AND c.leg = s.leg AND c.Date = s.d"""),
    "wide_files": (["fx_price_ri", "fx_price_mv", "days", "cells"], """SELECT s.DSCode,
  CAST(strptime(nullif(regexp_extract(s.h, '^(\\d{2}/\\d{2}/\\d{4}).*', 1), ''), '%d/%m/%Y') AS DATE) AS Date,
  TRY_CAST(c.cell AS DOUBLE) AS Value, s.Currency, s.leg, '_' || CAST(s.suffix AS VARCHAR) AS suffix
  FROM (SELECT *, day.d AS d, day.h AS h FROM (SELECT *, unnest((SELECT list(days) FROM days)) AS day
          FROM (SELECT DISTINCT DSCode, Currency, suffix, 'RI' AS leg FROM fx_price_ri
                UNION ALL SELECT DISTINCT NULL, Currency, suffix, 'RI' FROM fx_price_ri WHERE suffix = 0
                UNION ALL SELECT DISTINCT DSCode, Currency, suffix, 'MV' FROM fx_price_mv) x) y) s
  LEFT JOIN cells c ON c.DSCode = s.DSCode AND c.leg = s.leg AND c.Date = s.d"""),
}


# Portfolios: lag over the whole history, an inequality join, ranks by row_number.
CTES["fx_prices"] = ([], """SELECT 'U' || CAST(o_custkey AS VARCHAR) AS DSCode,
  CAST(CAST(l_shipdate AS DATE) + CAST(((o_custkey % 5) * 6 - 6) * 365 AS INTEGER) AS DATE) AS Date,
  CASE WHEN o_custkey % 2 = 0 THEN 'LC' ELSE 'USD' END AS Currency, l_extendedprice AS RI,
  CASE WHEN l_discount > 0 THEN l_quantity END AS MV FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
CTES["index_returns"] = (["fx_prices"], """SELECT DSCode, Date, Currency, RI / nullif(i0, 0) - 1 AS ret, w0 AS weight FROM (
  SELECT *, lag(RI) OVER (PARTITION BY DSCode, Currency ORDER BY Date) AS i0, lag(MV) OVER (PARTITION BY DSCode, Currency ORDER BY Date) AS w0
  FROM (SELECT *, row_number() OVER (PARTITION BY DSCode, Currency, Date ORDER BY RI, MV NULLS FIRST) AS rn FROM fx_prices
        WHERE RI IS NOT NULL AND Date IS NOT NULL) p WHERE rn = 1) q WHERE i0 IS NOT NULL""")
CTES["folio"] = (["final"], f"""SELECT *, year(fye_date) AS fye_year FROM (
  SELECT *, CA / nullif(CL, 0) AS CurrentRatio, (CA - CL) / nullif(CA, 0) AS WorkingCapital
  FROM ({_dates("SELECT * FROM " + _item_part('final', 2201, 'CA') + " a JOIN " + _item_part('final', 3101, 'CL')
                + " b USING (ws_id, point_date, freq, fiscal_period, cal1_55350)")}) d) f""")
CTES["spells"] = (["folio"], f"""SELECT company, from_date, CAST(least(coalesce(nxt, DATE '9999-01-01'), CAST(from_date + INTERVAL 12 MONTH AS DATE)) AS DATE) AS to_date,
  fye_bin, CurrentRatio, WorkingCapital FROM (
  SELECT ws_id AS company, ff92_date AS from_date, lead(ff92_date) OVER (PARTITION BY ws_id ORDER BY ff92_date) AS nxt, {_BIN} AS fye_bin,
    CurrentRatio, WorkingCapital
  FROM (SELECT *, row_number() OVER (PARTITION BY ws_id, ff92_date ORDER BY pit_date DESC, fye_date, CurrentRatio NULLS FIRST, WorkingCapital NULLS FIRST) AS rn
        FROM folio) r WHERE rn = 1) s""")
CTES["fx_company"] = ([], """SELECT 'U' || CAST(c_custkey AS VARCHAR) AS DSCD, 'C' || CAST(c_custkey AS VARCHAR) AS WC06105,
  c_nationkey AS GEOGC FROM customer""")
CTES["held"] = (["index_returns", "spells", "fx_company"], """SELECT r.DSCode, r.Date, r.Currency, r.ret, r.weight, m.GEOGC, m.WC06105,
  s.from_date, s.to_date, s.fye_bin, s.CurrentRatio, s.WorkingCapital
  FROM index_returns r LEFT JOIN fx_company m ON m.DSCD = r.DSCode
  JOIN spells s ON s.company = m.WC06105 AND r.Date >= s.from_date AND r.Date < s.to_date""")
CTES["folio_members"] = (["spells", "fx_company"], """SELECT company, from_date, to_date, fye_bin, GEOGC, predictor, value,
  CAST(1 + (rn_first > (n + 4) // 5)::INT + (rn_first > (2 * n + 4) // 5)::INT + (rn_first > (3 * n + 4) // 5)::INT
         + (rn_first > (4 * n + 4) // 5)::INT AS INTEGER) AS portfolio
  FROM (SELECT *, rank() OVER (PARTITION BY predictor, fye_bin, GEOGC ORDER BY value) AS rn_first,
          count(*) OVER (PARTITION BY predictor, fye_bin, GEOGC) AS n
        FROM (SELECT s.*, m.GEOGC FROM (
                SELECT company, from_date, to_date, fye_bin, 'CurrentRatio' AS predictor, CurrentRatio AS value FROM spells UNION ALL
                SELECT company, from_date, to_date, fye_bin, 'WorkingCapital', WorkingCapital FROM spells) s
              LEFT JOIN (SELECT WC06105, min(GEOGC) AS GEOGC FROM fx_company GROUP BY 1) m ON m.WC06105 = s.company
              WHERE value IS NOT NULL) v) w""")
CTES["folio_returns"] = (["folio_members", "index_returns", "fx_company"], """SELECT predictor, fye_bin, p.GEOGC, portfolio, Date, count(ret) AS n,
  avg(ret) AS ew_return, sum(CASE WHEN weight > 0 THEN weight * ret END) / nullif(sum(CASE WHEN weight > 0 AND ret IS NOT NULL THEN weight END), 0) AS vw_return
  FROM index_returns r JOIN fx_company m ON m.DSCD = r.DSCode
  JOIN folio_members p ON p.company = m.WC06105 AND r.Date >= p.from_date AND r.Date < p.to_date
  GROUP BY predictor, fye_bin, p.GEOGC, portfolio, Date""")

CTES["growth_items"] = (["final"], _dates("SELECT * FROM " + _item_part('final', 2201, 'CA') + " a JOIN " + _item_part('final', 3101, 'CL')
                                          + " b USING (ws_id, point_date, freq, fiscal_period, cal1_55350)"))
CTES["growth_prev"] = (["growth_items"], """SELECT * EXCLUDE (rn) FROM (
  SELECT c.ws_id, c.point_date, c.freq, c.fiscal_period, p.CA AS prev_CA, p.CL AS prev_CL,
    row_number() OVER (PARTITION BY c.ws_id, c.point_date, c.freq, c.fiscal_period ORDER BY p.point_date DESC, p.CA, p.CL) AS rn
  FROM (SELECT DISTINCT ws_id, point_date, freq, fiscal_period FROM growth_items) c
  JOIN growth_items p ON p.ws_id = c.ws_id AND p.freq = c.freq AND p.fiscal_period = c.fiscal_period - 1 AND p.point_date <= c.point_date) x
  WHERE rn = 1""")

CTES["wide_items"] = (["final_dedup"], "SELECT *, " + ", ".join(
    f"CAST(replace(cal1_{c}, '\"', '') AS DOUBLE) AS {n}" for c, n in _ACC_ITEMS) + " FROM ("
    "SELECT ws_id, point_date, freq, fiscal_period, cal1_55350, " + ", ".join(
    f"max(value) FILTER (WHERE item_code = {c}) AS cal1_{c}" for c, _ in _ACC_ITEMS)
    + " FROM final_dedup GROUP BY ws_id, point_date, freq, fiscal_period, cal1_55350) w")


def with_ctes(body: str, *needs: str) -> str:
    order: list = []

    def visit(n):
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


def _distribution_body(src, col, where=""):
    return f"""SELECT b.fye_bin, Mean, Median, StdDev, q."10thPct", q."90thPct" FROM
 (SELECT fye_bin, round(avg({col}), 1) AS Mean, CAST(median({col}) AS DOUBLE) AS Median,
         round(stddev_samp({col}), 6) AS StdDev FROM {src} {where} GROUP BY fye_bin) b
 LEFT JOIN
 (SELECT fye_bin,
         CAST(max(CASE WHEN rn = round((n - 1) * 0.1) + 1 THEN v END) AS DOUBLE) AS "10thPct",
         CAST(max(CASE WHEN rn = round((n - 1) * 0.9) + 1 THEN v END) AS DOUBLE) AS "90thPct"
  FROM (SELECT fye_bin, {col} AS v, row_number() OVER (PARTITION BY fye_bin ORDER BY {col}) AS rn,
               count(*) OVER (PARTITION BY fye_bin) AS n
        FROM {src} {where} {'AND' if where else 'WHERE'} {col} IS NOT NULL) r
  GROUP BY fye_bin) q
 ON b.fye_bin IS NOT DISTINCT FROM q.fye_bin"""


def _distribution(src, col, where=""):
    return with_ctes(_distribution_body(src, col, where), src)


_PANELS = (("panel_A_diff_pit_to_fye", "diff_to_fye", ""), ("panel_B_diff_pit_to_ff92", "diff_to_ff92", ""),
           ("panel_after_ff92_only", "diff_to_ff92", "WHERE diff_to_ff92 > 0"),
           ("panel_before_ff92_only", "diff_to_ff92", "WHERE diff_to_ff92 <= 0"))


def _availability(src):
    late = "sum(CASE WHEN diff_to_ff92 > 0 THEN 1 ELSE 0 END)"
    avail = "sum(CASE WHEN diff_to_ff92 <= 0 THEN 1 ELSE 0 END)"
    return with_ctes(f"""SELECT fye_bin, count(*) AS N, CAST({late} AS BIGINT) AS FF92_not_available,
 round({late} / count(*) * 100, 1) AS Pct_FF92_not_avail,
 CAST({avail} AS BIGINT) AS Data_available_by_FF92,
 round({avail} / count(*) * 100, 1) AS Pct_data_avail_by_FF92
 FROM {src} GROUP BY fye_bin""", src)


_PANEL_FROM_FILES = """SELECT r.DSCode, r.Date, r.Currency, r.RI, m.MV, x.GEOGC, x.WC06105
 FROM (SELECT DSCode, Date, Currency, suffix, Value AS RI FROM wide_files WHERE leg = 'RI') r
 SEMI JOIN (SELECT DISTINCT suffix, Currency FROM wide_files WHERE leg = 'MV') p
   ON r.suffix = p.suffix AND r.Currency = p.Currency
 LEFT JOIN (SELECT DSCode, Date, Currency, suffix, Value AS MV FROM wide_files WHERE leg = 'MV') m
   ON r.DSCode = m.DSCode AND r.Date = m.Date AND r.Currency = m.Currency AND r.suffix = m.suffix
 LEFT JOIN match_latest_v x ON r.DSCode = x.DSCD"""

_FILE = "'Daily' || CASE leg WHEN 'RI' THEN 'Returns' ELSE 'MV' END || Currency || suffix || '.csv'"

_ORDER_ALL = ("ws_id, point_date, freq, fiscal_period, item_code, value, ord, l_partkey, "
              "l_suppkey, cal1_55350, cal2_55559")

_MERGED_COLUMNS = ("ws_id point_date freq fiscal_period item_code value ord l_partkey l_suppkey cal1_55350 cal1_55352 cal1_55555 "
                   "cal1_57034 cal2_55558 cal2_55559").split()

SQL = {
    "pivot_calendar": with_ctes("SELECT * FROM cal1", "cal1"),
    "pivot_reported": with_ctes("SELECT * FROM cal2", "cal2"),
    "fundamentals_merged": with_ctes("SELECT * FROM merged", "merged"),
    "drop_missing_period": with_ctes("SELECT * FROM filtered", "filtered"),
    "keep_recent": with_ctes("SELECT * FROM final", "final"),
    "drop_columns": with_ctes("SELECT * FROM final_no_cols", "final_no_cols"),
    "split_by_item": with_ctes("SELECT * FROM final_no_cols WHERE item_code IS NOT NULL", "final_no_cols"),
    "item_filter": with_ctes("SELECT * FROM final_no_cols WHERE item_code = 2003", "final_no_cols"),
    "item_codes": with_ctes("SELECT DISTINCT item_code FROM final WHERE item_code IS NOT NULL", "final"),
    "lag_features": with_ctes("SELECT * FROM features", "features"),
    "year_bins": with_ctes("SELECT DISTINCT fye_year, fye_bin FROM features", "features"),
    "panel_a": _distribution("features", "diff_to_fye"),
    "panel_b": _distribution("features", "diff_to_ff92"),
    "panel_c": _availability("features"),
    "panel_c_merged": _availability("features_merged"),
    "panel_after": _distribution("features", "diff_to_ff92", "WHERE diff_to_ff92 > 0"),
    "panel_before": _distribution("features", "diff_to_ff92", "WHERE diff_to_ff92 <= 0"),
    "lag_counts": with_ctes("""SELECT CAST(sum(CASE WHEN diff_to_ff92 <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_on_or_before_ff92,
 CAST(sum(CASE WHEN diff_to_ff92 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_after_ff92 FROM features""", "features"),
    "items_wide_chain": with_ctes(_chain("final"), "final"),
    "items_wide_split": with_ctes(_chain("final"), "final"),
    "items_wide_dedup": with_ctes(_pivot("final_dedup"), "final_dedup"),
    "panel_set": with_ctes(" UNION ALL ".join(
        f"SELECT '{n}' AS panel, * FROM ({_distribution_body('features', c, w)}) p" for n, c, w in _PANELS), "features"),
    "table_shape": with_ctes("""SELECT count(*) AS n_rows,
 CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM merged)) AS INTEGER) AS n_columns FROM merged""", "merged"),
    "panel_append": with_ctes("SELECT * FROM price_join_v", "price_join_v"),
    "skip_existing": with_ctes("""SELECT DSCD, WC06105, CAST(GEOGC AS VARCHAR) AS GEOGC, CAST(ISIN AS VARCHAR) AS ISIN, TIME
 FROM (SELECT *, row_number() OVER (PARTITION BY DSCD, WC06105 ORDER BY t DESC NULLS LAST, CAST(ISIN AS VARCHAR)) AS rn
       FROM fx_match) x WHERE rn = 1""", "fx_match"),
    "items_wide_pivot": with_ctes(_pivot("final_dedup"), "final_dedup"),
    "items_wide_fallback": with_ctes(
        f"SELECT *, (CA - CL - Cash + STD) / nullif(TA, 0) AS Acc FROM ({_dates('SELECT * FROM wide_items')}) p",
        "wide_items"),
    "predictor_acc": with_ctes(
        f"SELECT *, (CA - CL - Cash + STD) / nullif(TA, 0) AS Acc FROM ({_dates(_chain('final'))}) p", "final"),
    "predictor_registry": with_ctes(
        "SELECT *, Acc * 100 AS AccPct FROM ("
        f"SELECT *, (CA - CL - Cash + STD) / nullif(TA, 0) AS Acc FROM ({_dates(_chain('final_no_cols'))}) p) a",
        "final_no_cols"),
    "predictor_growth": with_ctes("""SELECT g.*, (g.CA - prev_CA) / nullif(prev_CA, 0) AS AssetGrowth,
 g.CA / nullif(g.CL, 0) - prev_CA / nullif(prev_CL, 0) AS RatioChange,
 CASE WHEN g.CL > g.CA THEN g.CA / nullif(g.CL / nullif(g.CA / 2, 0), 0) END AS PerRisk
 FROM growth_items g LEFT JOIN growth_prev p USING (ws_id, point_date, freq, fiscal_period)""", "growth_items", "growth_prev"),
    "predictor_columns": with_ctes(
        "SELECT ws_id, point_date, freq, fiscal_period, cal1_55350, Cash, CA, STD, CL, TA, "
        f"(CA - CL - Cash + STD) / nullif(TA, 0) AS Acc FROM ({_pivot('final_dedup')}) p", "final_dedup"),
    "index_returns": with_ctes("SELECT * FROM index_returns", "index_returns"),
    "returns_joined": with_ctes("SELECT * FROM held", "held"),
    "portfolio_members": with_ctes("SELECT * FROM folio_members", "folio_members"),
    "portfolio_returns": with_ctes("SELECT * FROM folio_returns", "folio_returns"),
    "portfolio_spreads": with_ctes("""SELECT predictor, fye_bin, GEOGC, count(e5 - e1) AS n_days, avg(e5 - e1) AS ew_spread, avg(v5 - v1) AS vw_spread
 FROM (SELECT predictor, fye_bin, GEOGC, Date, sum(ew_return) FILTER (WHERE portfolio = 1) AS e1, sum(ew_return) FILTER (WHERE portfolio = 5) AS e5,
         sum(vw_return) FILTER (WHERE portfolio = 1) AS v1, sum(vw_return) FILTER (WHERE portfolio = 5) AS v5
       FROM folio_returns WHERE portfolio IN (1, 5) GROUP BY ALL) d GROUP BY ALL""", "folio_returns"),
    "unpivot_prices": with_ctes("SELECT * FROM wide_long", "wide_long"),
    "date_header_extract": with_ctes(r"""SELECT DSCode, Currency, leg, Date AS header,
 nullif(regexp_extract(Date, '^(\d{2}/\d{2}/\d{4}).*', 1), '') AS CleanDate,
 CAST(strptime(nullif(regexp_extract(Date, '^(\d{2}/\d{2}/\d{4}).*', 1), ''), '%d/%m/%Y') AS DATE) AS Date
 FROM wide_long""", "wide_long"),
    "lenient_cast": with_ctes(r"""SELECT DSCode, Currency, leg,
 CAST(strptime(nullif(regexp_extract(Date, '^(\d{2}/\d{2}/\d{4}).*', 1), ''), '%d/%m/%Y') AS DATE) AS Date,
 TRY_CAST(Value AS DOUBLE) AS Price FROM wide_long""", "wide_long"),
    "price_join": with_ctes("SELECT * FROM price_join_v", "price_join_v"),
    "price_union": with_ctes("""SELECT DSCode, Date, Currency, suffix, RI, CAST(NULL AS DOUBLE) AS MV FROM fx_price_ri
 UNION ALL SELECT DSCode, Date, Currency, suffix, CAST(NULL AS DOUBLE) AS RI, MV FROM fx_price_mv""",
                             "fx_price_ri", "fx_price_mv"),
    "match_latest": with_ctes("SELECT * FROM match_latest_v", "match_latest_v"),
    "match_dedup_nodate": with_ctes("""SELECT DSCD, WC06105, GEOGC, ISIN FROM (SELECT *, row_number() OVER (
 PARTITION BY DSCD, WC06105 ORDER BY GEOGC NULLS FIRST, ISIN NULLS FIRST) AS rn FROM fx_match) x WHERE rn = 1""", "fx_match"),
    "price_match": with_ctes("""SELECT p.*, m.GEOGC, m.WC06105 FROM price_join_v p
 LEFT JOIN match_latest_v m ON p.DSCode = m.DSCD""", "price_join_v", "match_latest_v"),
    "attach_item": with_ctes("""SELECT p.WC06105, p.Date, f.value AS WS2003_PIT
 FROM (SELECT DISTINCT ws_id AS WC06105, CAST(point_date + CAST(ord % 2 AS INTEGER) AS DATE) AS Date FROM fx_period) p
 LEFT JOIN (SELECT ws_id, point_date, value FROM fx_facts WHERE item_code = 2003) f
   ON p.WC06105 = f.ws_id AND p.Date = f.point_date""", "fx_period", "fx_facts"),
    "profile_nulls": with_ctes("""SELECT 'cal2_55558' AS column_name, CAST(count(*) - count(cal2_55558) AS BIGINT) AS null_count,
 CAST(count(DISTINCT cal2_55558) AS BIGINT) AS unique_count FROM merged
 UNION ALL SELECT 'cal2_55559', CAST(count(*) - count(cal2_55559) AS BIGINT),
 CAST(count(DISTINCT cal2_55559) AS BIGINT) FROM merged""", "merged"),
    "profile_top10": with_ctes("""SELECT cal2_55559, count(*) AS frequency FROM merged GROUP BY cal2_55559
 ORDER BY frequency DESC, cal2_55559 ASC NULLS FIRST LIMIT 10""", "merged"),
    "profile_columns": with_ctes(" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, value, frequency, (SELECT count(*) - count({c}) FROM merged) AS null_count,
 (SELECT count(DISTINCT {c}) FROM merged) AS unique_count FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS frequency FROM merged GROUP BY 1
 ORDER BY frequency DESC, value ASC NULLS FIRST LIMIT 10) t""" for c in _MERGED_COLUMNS), "merged"),
    "value_counts": with_ctes("SELECT freq, count(*) AS counts FROM final WHERE freq IS NOT NULL GROUP BY freq", "final"),
    "fundamentals_from_files": with_ctes("""SELECT ws_id, point_date, freq, fiscal_period, item_code,
 replace(value, '"', '') AS value, replace(cal1_55350, '"', '') AS cal1_55350, cal1_55352, cal1_55555, cal1_57034,
 cal2_55558, cal2_55559 FROM merged""", "merged"),
    "pipe_scan": with_ctes("SELECT ws_id, point_date, freq, item_code, value FROM fx_reported", "fx_reported"),
    "wide_price_files": with_ctes("SELECT * FROM wide_files", "wide_files"),
    "price_panel_from_files": with_ctes(_PANEL_FROM_FILES, "wide_files", "match_latest_v"),
    "matching_from_files": with_ctes("""SELECT DSCD, WC06105, CAST(GEOGC AS VARCHAR) AS GEOGC, CAST(ISIN AS VARCHAR) AS ISIN, TIME
 FROM (SELECT *, row_number() OVER (PARTITION BY DSCD, WC06105 ORDER BY t DESC NULLS LAST, CAST(ISIN AS VARCHAR)) AS rn
       FROM fx_match) x WHERE rn = 1""", "fx_match"),
    "parquet_append": with_ctes("""SELECT DSCode, Date, Currency, RI, CAST(NULL AS DOUBLE) AS MV, CAST(NULL AS BIGINT) AS suffix FROM fx_price_ri
 UNION ALL SELECT DSCode, Date, Currency, NULL, MV, suffix FROM fx_price_mv""", "fx_price_ri", "fx_price_mv"),
    "parquet_quarantine": with_ctes("""SELECT DSCode, Date, Currency, RI, CAST(NULL AS DOUBLE) AS MV, suffix,
 'broken_1.parquet,broken_2.parquet' AS bad_files FROM fx_price_ri
 UNION ALL SELECT DSCode, Date, Currency, NULL, MV, suffix, 'broken_1.parquet,broken_2.parquet' FROM fx_price_mv""", "fx_price_ri", "fx_price_mv"),
    "fundamentals_to_items": with_ctes("""SELECT ws_id, point_date, freq, fiscal_period, item_code, replace(value, '"', '') AS value,
 replace(cal1_55350, '"', '') AS cal1_55350, cal2_55559 FROM final_no_cols""", "final_no_cols"),
    "pipe_notes": with_ctes("""SELECT ws_id, point_date, freq, fiscal_period, item_code,
 CASE WHEN ord % 103 = 0 THEN NULL WHEN ord % 7 = 0 THEN 'See item ' || item_code || ',' || chr(10) || 'restated | "twice"'
      WHEN ord % 11 = 0 THEN 'about 6" wide, ' || item_code ELSE 'plain ' || item_code END AS note,
 ord % 101 = 0 OR ord % 103 = 0 AS is_bad FROM fx_facts""", "fx_facts"),
    "incremental_load": with_ctes(f"""SELECT {_FILE} AS file, CAST(CASE Currency WHEN 'LC' THEN 1 ELSE 2 END AS INTEGER) AS batch, count(*) AS rows,
 CAST(CASE Currency WHEN 'LC' THEN 1 + (SELECT count(DISTINCT (suffix, leg)) FROM wide_files WHERE Currency = 'LC')
      ELSE 1 + (SELECT count(DISTINCT (suffix, leg)) FROM wide_files WHERE Currency = 'USD') END AS INTEGER) AS new_files,
 CAST(0 AS INTEGER) AS new_in_last_run FROM wide_files GROUP BY Currency, leg, suffix""", "wide_files"),
    "panel_with_item": with_ctes("""SELECT p.DSCode, p.Date, p.Currency, p.RI, p.MV, m.GEOGC, m.WC06105, f.value AS WS2201_PIT
 FROM fx_prices p LEFT JOIN fx_company m ON m.DSCD = p.DSCode
 LEFT JOIN (SELECT ws_id, point_date, value FROM final_no_cols WHERE item_code = 2201) f ON f.ws_id = m.WC06105 AND f.point_date = p.Date""",
                                 "fx_prices", "fx_company", "final_no_cols"),
    "load_report": with_ctes(f"""SELECT job, source, status, CAST(rows AS BIGINT) AS rows, CAST(bad_rows AS BIGINT) AS bad_rows FROM (
 SELECT 'matching' AS job, 'csv' AS source, 'loaded' AS status, count(*) AS rows, 0 AS bad_rows FROM fx_match
 UNION ALL SELECT 'matching', 'empty.csv', 'empty', 0, 0
 UNION ALL SELECT 'matching', 'match', 'written', count(*), 0 FROM match_latest_v
 UNION ALL SELECT 'prices', {_FILE}, 'loaded', count(*), count(*) FILTER (DSCode IS NULL) FROM wide_files GROUP BY Currency, leg, suffix
 UNION ALL SELECT 'prices', 'DailyReturnsLC_8.csv', 'no header', 0, 0
 UNION ALL SELECT 'prices', 'DailyReturnsUSD_7.csv', 'empty', 0, 0
 UNION ALL SELECT 'prices', 'panel', 'written', count(*), 0 FROM ({_PANEL_FROM_FILES}) x
 UNION ALL SELECT 'fundamentals', 'WSFV', 'loaded', count(*), 0 FROM fx_facts
 UNION ALL SELECT 'fundamentals', 'WSCalendarPrd', 'loaded', count(*), 0 FROM fx_calendar
 UNION ALL SELECT 'fundamentals', 'WSReportedPrd', 'loaded', count(*), 0 FROM fx_reported
 UNION ALL SELECT 'fundamentals', 'items', 'written', count(*), 0 FROM final_no_cols
 UNION ALL SELECT 'panels', n, 'written', count(DISTINCT coalesce(fye_bin, '-')), 0 FROM features, (SELECT unnest(['panel_A_diff_pit_to_fye',
   'panel_B_diff_pit_to_ff92', 'panel_C_availability_at_FF92']) AS n) GROUP BY n
 UNION ALL SELECT 'panels', 'panel_after_ff92_only', 'written', count(DISTINCT coalesce(fye_bin, '-')), 0 FROM features WHERE diff_to_ff92 > 0
 UNION ALL SELECT 'panels', 'panel_before_ff92_only', 'written', count(DISTINCT coalesce(fye_bin, '-')), 0 FROM features WHERE diff_to_ff92 <= 0
 UNION ALL SELECT 'panels', 'lag_counts', 'written', 1, 0
 UNION ALL SELECT 'predictors', 'predictors', 'written', count(*), 0 FROM ({_chain('final')}) x
 UNION ALL SELECT 'attach_item', 'panel_item', 'written', count(*), 0 FROM ({_PANEL_FROM_FILES}) x) r""",
                             "fx_match", "match_latest_v", "wide_files", "fx_facts", "fx_calendar", "fx_reported", "final", "final_no_cols", "features"),
    "csv_roundtrip": _availability("features_merged"),
    "stream_ingest": with_ctes("""SELECT ws_id, point_date, freq, fiscal_period, item_code, replace(value, '"', '') AS value
 FROM fx_calendar""", "fx_calendar"),
    "head_export": with_ctes(
        f"SELECT * FROM final_no_cols ORDER BY {', '.join(c + ' ASC NULLS FIRST' for c in _ORDER_ALL.split(', '))} LIMIT 10000",
        "final_no_cols"),
}
