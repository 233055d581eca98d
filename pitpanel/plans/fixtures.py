"""Domain tables derived from the driver's TPC-H-like tables.

The driver supplies orders, lineitem, events and customer; these functions
map them onto the panel domain (company-periods, EAV facts, calendar and
reported periods, price legs, matching rows, a price panel) with plain
DataFrame operations, so every query's work grows with the given tables.
The modulo rules below shape the synthetic data (period records under another
key, so that facts miss them; '0' markers, currencies, file suffixes). No row
of a used table is left out: every event is in a price leg, every order in
both period tables.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.schemas import CAL1_CODES, CAL2_CODES


# Schemas of the driver's tables used here (as written by the driver).
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


class Tables:
    """Lazy parquet readers for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._frames: dict = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # One reader per table: each parquet read costs a footer (schema) job.
        if name not in self._frames:
            reader = self.spark.read
            if name in TABLE_SCHEMAS:            # declared: no footer job for inference
                reader = reader.schema(TABLE_SCHEMAS[name])
            self._frames[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]


def _memo(fn):
    """Build each derived frame once per ``Tables`` (the same DataFrame object
    is reused wherever it appears in a plan)."""
    def wrapped(t: Tables) -> DataFrame:
        key = "_" + fn.__name__
        if key not in t._frames:
            t._frames[key] = fn(t)
        return t._frames[key]
    wrapped.__name__, wrapped.__doc__ = fn.__name__, fn.__doc__
    return wrapped


def _s(c) -> Column:
    return F.col(c).cast("string")


@_memo
def period(t: Tables) -> DataFrame:
    """One row per order = one company-period (15,000 at sf0.01)."""
    o = t.orders
    fye = F.date_add(F.col("o_orderdate").cast("date"),
                     (((F.col("o_custkey") % 5) * 6 - 6) * 365).cast("int"))
    return (o.select(F.concat(F.lit("C"), _s("o_custkey")).alias("ws_id"),
                     fye.alias("fye"), "o_orderkey", "o_orderstatus")
            .select("ws_id",
                    F.date_add("fye", ((F.col("o_orderkey") * 37) % 400).cast("int"))
                    .alias("point_date"),
                    F.col("o_orderstatus").alias("freq"),
                    F.year("fye").cast("bigint").alias("fiscal_period"),
                    "fye",
                    F.col("o_orderkey").alias("ord")))


@_memo
def facts(t: Tables) -> DataFrame:
    """EAV facts: one row per line item, item code by line number."""
    item = (F.when(F.col("l_linenumber") == 1, 2201).when(F.col("l_linenumber") == 2, 3101)
            .when(F.col("l_linenumber") == 3, 2003).when(F.col("l_linenumber") == 4, 3051)
            .when(F.col("l_linenumber") == 5, 6699).when(F.col("l_linenumber") == 6, 5490)
            .otherwise(7240))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey")
    p = period(t).drop("fye")
    return (li.join(p, li["l_orderkey"] == p["ord"])
            .select("ws_id", "point_date", "freq", "fiscal_period",
                    item.cast("bigint").alias("item_code"),
                    F.concat(F.lit('"'), _s("l_extendedprice"), F.lit('"')).alias("value"),
                    "ord", "l_partkey", "l_suppkey"))


@_memo
def calendar(t: Tables) -> DataFrame:
    return calendar_rows(period(t))


def calendar_rows(periods: DataFrame) -> DataFrame:
    """Calendar-period EAV rows (4 codes per period; for ord % 50 = 0 under the
    next fiscal period, so that the facts miss them)."""
    p = periods.withColumn("fiscal_period", F.col("fiscal_period") + F.when(F.col("ord") % 50 == 0, 1).otherwise(0))
    p = p.withColumn("item_code", F.explode(F.array(*[F.lit(c).cast("bigint") for c in CAL1_CODES])))
    fye_num = F.year("fye") * 10000 + F.month("fye") * 100 + F.dayofmonth("fye")
    value = (F.when(F.col("item_code") == 55350, F.concat(F.lit('"d'), fye_num.cast("string"), F.lit('"')))
             .when(F.col("item_code") == 55352, F.lit("12"))
             .when(F.col("item_code") == 55555, _s("fiscal_period"))
             .otherwise(F.lit("x")))
    return p.select("ws_id", "point_date", "freq", "fiscal_period", "item_code",
                    value.alias("value"), "ord")


@_memo
def reported(t: Tables) -> DataFrame:
    return reported_rows(period(t))


def reported_rows(periods: DataFrame) -> DataFrame:
    """Reported-period EAV rows (2 codes; for ord % 33 = 0 under frequency
    ``R``, so that the facts miss them; both '0' for ord % 10 = 0; a stale
    year for ord % 4 = 0)."""
    p = periods.withColumn("freq", F.when(F.col("ord") % 33 == 0, "R").otherwise(F.col("freq")))
    p = p.withColumn("item_code", F.explode(F.array(*[F.lit(c).cast("bigint") for c in CAL2_CODES])))
    value = (F.when(F.col("ord") % 10 == 0, F.lit("0"))
             .when(F.col("item_code") == 55558, F.lit("1"))
             .when(F.col("ord") % 4 == 0, F.lit("1900"))
             .otherwise(_s("fiscal_period")))
    return p.select("ws_id", "point_date", "freq", "item_code", value.alias("value"), "ord")


MV_EVENTS = ("click", "view")           # every other event type is in the return leg


def _price_leg(t: Tables, name: str, is_mv: bool) -> DataFrame:
    mv = F.coalesce(F.col("event_type").isin(*MV_EVENTS), F.lit(False))
    suffix = F.col("user_id") % 3
    if is_mv:
        suffix = F.when((suffix == 2) & (F.col("user_id") % 2 == 1), 3).otherwise(suffix)
    return (t.events.select("user_id", "ts", "event_type", "value").where(mv if is_mv else ~mv)
            .groupBy("user_id", F.col("ts").cast("date").alias("Date"))
            .agg(F.max("value").alias(name))
            .select(F.concat(F.lit("U"), _s("user_id")).alias("DSCode"), "Date",
                    F.when(F.col("user_id") % 2 == 0, "LC").otherwise("USD").alias("Currency"),
                    suffix.cast("bigint").alias("suffix"), name))


@_memo
def price_ri(t: Tables) -> DataFrame:
    """Return-index leg, long (DSCode, Date, Currency, suffix, RI)."""
    return _price_leg(t, "RI", False)


@_memo
def price_mv(t: Tables) -> DataFrame:
    """Market-value leg; its USD file of suffix 2 is numbered 3, so that this
    file and the returns of suffix 2 have no partner."""
    return _price_leg(t, "MV", True)


@_memo
def match_rows(t: Tables) -> DataFrame:
    """Matching-file rows with ``dd/MM/yyyy`` TIME text."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey")
    d = F.col("o_orderdate")
    time_text = F.concat_ws("/", F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
                            F.lpad(F.month(d).cast("string"), 2, "0"), F.year(d).cast("string"))
    return (o.join(c, o["o_custkey"] == c["c_custkey"])
            .select(F.concat(F.lit("U"), _s("o_custkey")).alias("DSCD"),
                    F.concat(F.lit("C"), _s("o_custkey"), F.lit("-"),
                             F.substring("o_orderpriority", 1, 1)).alias("WC06105"),
                    F.col("c_nationkey").alias("GEOGC"),
                    F.col("o_orderkey").alias("ISIN"),
                    time_text.alias("TIME")))


@_memo
def security_prices(t: Tables) -> DataFrame:
    """A long price history per security: one row per customer and shifted ship date (the shift of
    ``period``, so that prices lie around the fiscal year ends); no market value where the discount is 0."""
    li = t.lineitem.select("l_orderkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey")
    day = F.date_add(F.col("l_shipdate").cast("date"), (((F.col("o_custkey") % 5) * 6 - 6) * 365).cast("int"))
    return (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .select(F.concat(F.lit("U"), _s("o_custkey")).alias("DSCode"), day.alias("Date"),
                    F.when(F.col("o_custkey") % 2 == 0, "LC").otherwise("USD").alias("Currency"),
                    F.col("l_extendedprice").alias("RI"),
                    F.when(F.col("l_discount") > 0, F.col("l_quantity")).alias("MV")))


@_memo
def company_match(t: Tables) -> DataFrame:
    """Matching rows whose company ids are those of the facts (one per customer)."""
    return t.customer.select(F.concat(F.lit("U"), _s("c_custkey")).alias("DSCD"),
                             F.concat(F.lit("C"), _s("c_custkey")).alias("WC06105"), F.col("c_nationkey").alias("GEOGC"))


def wide_prices(t: Tables) -> DataFrame:
    """Wide price frame: one row per leg and security, one text column per day from the
    first to the last event, headed ``dd/MM/yyyy``; the 15th's header carries a
    duplicate marker, the 30th's is not a date, and cells of a 2nd of every
    seventh user read ``NA``. Built with a grouped pivot over the header list.
    """
    legs = [wide_from_leg(frame, leg, wide_headers(t)).withColumn("leg", F.lit(leg)) for leg, frame in
            (("RI", price_ri(t)), ("MV", price_mv(t)))]
    both = legs[0].unionByName(legs[1]).drop("suffix")
    return both.select("DSCode", "Currency", "leg", *[F.col(f"`{c}`") for c in both.columns if c not in ("DSCode", "Currency", "leg")])


def wide_from_leg(ri: DataFrame, value_col: str, headers: list) -> DataFrame:
    """One leg (long) -> wide text cells, see ``wide_prices``."""
    day = F.dayofmonth("Date")
    header = (F.when(day == 15, F.concat(F.date_format("Date", "dd/MM/yyyy"), F.lit("_duplicated_0")))
              .when(day == 30, F.concat(F.lit("Unnamed: "), F.date_format("Date", "yyyyMM")))
              .otherwise(F.date_format("Date", "dd/MM/yyyy")))
    uid = F.substring("DSCode", 2, 20).cast("bigint")
    cell = F.when((day == 2) & (uid % 7 == 0), F.lit("NA")).otherwise(F.col(value_col).cast("string"))
    return (ri.select("DSCode", "Currency", "suffix", header.alias("h"), cell.alias("cell"))
            .groupBy("DSCode", "Currency", "suffix").pivot("h", headers).agg(F.max("cell")))


def wide_headers(t: Tables) -> list:
    """One header per day of the events' date range (one row reaches the driver)."""
    if "_headers" not in t._frames:
        day = F.col("ts").cast("date")
        first, last = t.events.agg(F.min(day), F.max(day)).first()
        days = [first + timedelta(days=i) for i in range((last - first).days + 1)] if first else []
        t._frames["_headers"] = [
            f"{d:%d/%m/%Y}_duplicated_0" if d.day == 15 else f"Unnamed: {d:%Y%m}" if d.day == 30 else f"{d:%d/%m/%Y}"
            for d in days]
    return t._frames["_headers"]


def price_panel_keys(t: Tables) -> DataFrame:
    """Panel keys (company, date); odd orders shift the date by a day."""
    return (period(t).select(F.col("ws_id").alias("WC06105"),
                             F.date_add("point_date", (F.col("ord") % 2).cast("int")).alias("Date"))
            .distinct())
