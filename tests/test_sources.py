import os

import pytest
from pyspark.sql import functions as F

from pitpanel.session import local_path
from pitpanel.sources import sinks
from pitpanel.sources.fundamentals import kind_of, read_fundamentals
from pitpanel.sources.items import available_items, read_items
from pitpanel.sources.matching import read_matching_csv, read_parquet_folder
from pitpanel.sources.prices import split_legs, wide_prices_long


def write(path, data: bytes):
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def test_kind_of():
    assert kind_of("/x/WSFV_20250131.txt") == "WSFV"
    assert kind_of("WSReportedPrd_f_2025.txt") == "WSReportedPrd"
    assert kind_of("other.txt") is None


def test_pipe_windows_1252(spark, tmpdir_uri):
    write(f"{tmpdir_uri}/WSFV_1.txt", "C1|20201231|A|2020|2201|caf\xe9\n".encode("windows-1252"))
    write(f"{tmpdir_uri}/WSReportedPrd_1.txt", b"C1|20201231|A|55559|2020\n")
    k = read_fundamentals(spark, tmpdir_uri)
    r = k["WSFV"].collect()[0]
    assert r["value"] == "café" and r["item_code"] == 2201 and r["fiscal_period"] == 2020
    assert str(r["point_date"]) == "2020-12-31"
    assert k["WSReportedPrd"].columns[:5] == ["ws_id", "point_date", "freq", "item_code", "value"]


def test_unknown_kind_uses_header(spark, tmpdir_uri):
    write(f"{tmpdir_uri}/WSNewThing_1.txt", b"ws_id|item_code|value\nC1|5|x\n")
    k = read_fundamentals(spark, tmpdir_uri)
    r = k["WSNewThing"].collect()
    assert len(r) == 1 and r[0]["ws_id"] == "C1"


def test_empty_matching_file(spark, tmpdir_uri):
    write(f"{tmpdir_uri}/a.csv", b"DSCD,ISIN,WC06105,TIME\nU1,I1,C1,01/02/2003\n")
    write(f"{tmpdir_uri}/empty.csv", b"")
    df = read_matching_csv(spark, tmpdir_uri)
    assert df.count() == 1 and df.schema["ISIN"].dataType.simpleString() == "string"


WIDE = (b'"Daily returns"\n'
        b'Name,DATES,CURRENCY,ISIN,GEOG,SECTOR,Source,01/02/2024,02/02/2024_duplicated_0,Notes\n'
        b'"Acme, Inc",A1,LC,,,,DS,1.5,NA,\n'
        b'"Beta",B2,LC,,,,DS,,2,3\n')


def test_wide_price_file(spark, tmpdir_uri):
    write(f"{tmpdir_uri}/LC/DailyReturnsLC_x.csv", WIDE)
    write(f"{tmpdir_uri}/LC/DailyMVLC_x.csv", WIDE)
    write(f"{tmpdir_uri}/LC/Index Returns/DailyReturnsLC_i.csv", WIDE)
    long = wide_prices_long(spark, tmpdir_uri)
    rows = sorted((r["DSCode"], str(r["Date"]), r["Value"], r["leg"]) for r in long.collect())
    assert len(rows) == 12                                     # 2 files x 2 securities x 3 columns
    a = [r for r in rows if r[0] == "A1" and r[3] == "RI"]
    assert a == [("A1", "2024-02-01", 1.5, "RI"), ("A1", "2024-02-02", None, "RI"), ("A1", "None", None, "RI")]
    assert {r["Currency"] for r in long.collect()} == {"LC"}
    assert {r["suffix"] for r in long.collect()} == {"_x"}
    ri, mv = split_legs(long)
    assert ri.count() == 6 and mv.count() == 6


def test_item_partitions(spark, tmpdir_uri):
    df = spark.createDataFrame([("c", 1, "v"), ("c", None, "w"), ("d", 2, "x")],
                               "ws_id string, item_code bigint, value string")
    sinks.write_by_item(df, tmpdir_uri)
    assert read_parquet_folder(spark, tmpdir_uri).count() == 2          # NULL item not written
    with pytest.warns(UserWarning):
        assert available_items(spark, tmpdir_uri, [1, 2, 3]) == [1, 2]
    q = read_items(spark, tmpdir_uri, [1])
    assert q.count() == 1
    assert "PartitionFilters: [isnotnull(item_code" in q._jdf.queryExecution().executedPlan().toString()


def test_parquet_folder_union_by_name(spark, tmpdir_uri):
    sinks.write_parquet(spark.createDataFrame([(1, "a")], "k int, a string"), tmpdir_uri, mode="append")
    sinks.write_parquet(spark.createDataFrame([(2, 5)], "k int, b int"), tmpdir_uri, mode="append")
    df = read_parquet_folder(spark, tmpdir_uri)
    assert sorted(df.columns) == ["a", "b", "k"] and df.count() == 2


def test_head_export_and_ignore(spark, tmpdir_uri):
    df = spark.range(100).select(F.col("id").alias("v"))
    sinks.export_head(df, tmpdir_uri, 10, ["v"])
    back = spark.read.schema("v bigint").option("header", "true").csv(tmpdir_uri)
    assert sorted(r[0] for r in back.collect()) == list(range(10))
    sinks.write_parquet(df, tmpdir_uri + "_p")
    sinks.write_parquet(df.limit(1), tmpdir_uri + "_p", mode="ignore")   # existing output kept
    assert spark.read.parquet(tmpdir_uri + "_p").count() == 100


def test_row_count_observation(spark):
    df, obs = sinks.with_row_count(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_plus_and_space_in_file_names(spark, tmpdir_uri):
    write(f"{tmpdir_uri}/USD/DailyMVUSD_a+b c.csv", WIDE)
    long = wide_prices_long(spark, tmpdir_uri)
    r = long.select("suffix", "Currency", "leg").distinct().collect()
    assert [tuple(x) for x in r] == [("_a+b c", "USD", "MV")]


def test_files_without_kind_are_skipped():
    from pitpanel.sources.fundamentals import group_by_kind
    with pytest.warns(UserWarning):
        g = group_by_kind(["/a/WSFV_1.txt", "/a/readme.txt", "/a/WSFVFootnote_1.txt", "/a/WSFV_2.txt"])
    assert g == {"WSFV": ["/a/WSFV_1.txt", "/a/WSFV_2.txt"], "WSFVFootnote": ["/a/WSFVFootnote_1.txt"]}


def test_wide_prices_quoted_commas_and_short_lines(spark, tmpdir_uri):
    from pitpanel.sources.prices import wide_prices_long
    text = ('banner\nName,DATES,c,d,e,f,g,01/01/2020,02/01/2020,03/01/2020\n'
            '"A, Inc",X1,,,,,,5,"1,234.5",3\nC,X3,,,,,,7\n')
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{tmpdir_uri}/LC")
    import glob, shutil
    part = glob.glob(f"{tmpdir_uri.removeprefix('file:')}/LC/*.txt")[0]
    shutil.copy(part, part.rsplit("/", 1)[0] + "/RI_1.csv")
    got = {(r.DSCode, r.Date.day, r.Value) for r in wide_prices_long(spark, tmpdir_uri).collect()}
    assert got == {("X1", 1, 5.0), ("X1", 2, None), ("X1", 3, 3.0), ("X3", 1, 7.0), ("X3", 2, None), ("X3", 3, None)}


BANNERED = ('Daily returns, LC, 2020, "all"\nName,DATES,c,d,e,f,g,01/01/2020,02/01/2020\n'
            'A,X1,,,,,,5,6\n\nTotal\nB,X2,,,,,,7,8\n')


def test_banner_is_the_first_line_whatever_it_holds(spark, tmpdir_uri):
    write(f"{tmpdir_uri}/LC/DailyReturnsLC_1.csv", BANNERED.encode())
    # a banner that looks like a header, and the header's line again below
    write(f"{tmpdir_uri}/LC/DailyMVLC_1.csv", b"Prices,DATES\nName,DATES,c,d,e,f,g,01/01/2020\nA,X1,,,,,,5\n")
    got = sorted((r.leg, r.DSCode, str(r.Date), r.Value) for r in wide_prices_long(spark, tmpdir_uri).collect() if r.DSCode)
    assert got == [("MV", "X1", "2020-01-01", 5.0), ("RI", "X1", "2020-01-01", 5.0), ("RI", "X1", "2020-01-02", 6.0),
                   ("RI", "X2", "2020-01-01", 7.0), ("RI", "X2", "2020-01-02", 8.0)]
    none = [r for r in wide_prices_long(spark, tmpdir_uri).collect() if r.DSCode is None]
    assert [(str(r.Date), r.Value) for r in none] == [("2020-01-01", None), ("2020-01-02", None)]       # "Total"


def test_price_report_pairs_and_scans(spark, tmpdir_uri):
    from pitpanel.plans.jobs import price_store
    from pitpanel.plans.prices import price_panel
    from pitpanel.sources.prices import leg_pairs, price_manifest
    write(f"{tmpdir_uri}/in/LC/DailyReturnsLC_1.csv", BANNERED.encode())
    write(f"{tmpdir_uri}/in/LC/DailyMVLC_1.csv", BANNERED.encode())
    write(f"{tmpdir_uri}/in/LC/DailyReturnsLC_2.csv", BANNERED.encode())                # no partner
    write(f"{tmpdir_uri}/in/USD/DailyReturnsUSD_1.csv", b"banner\nNo,header\nA,X1,,,,,,1,2\n")
    write(f"{tmpdir_uri}/in/USD/DailyMVUSD_1.csv", b"")
    write(f"{tmpdir_uri}/in/USD/Index Returns/DailyMVUSD_1.csv", BANNERED.encode())
    pairs = {(r.suffix, r.Currency) for r in leg_pairs(price_manifest(spark, f"{tmpdir_uri}/in")).collect()}
    assert pairs == {("_1", "LC"), ("_1", "USD")}                                        # from names alone
    ri, mv, pairs = price_store(spark, f"{tmpdir_uri}/in", f"{tmpdir_uri}/store", f"{tmpdir_uri}/report")
    got = {(r.source, r.status, r.rows, r.bad_rows) for r in spark.read.parquet(f"{tmpdir_uri}/report").collect()}
    assert got == {("DailyReturnsLC_1.csv", "loaded", 6, 2), ("DailyMVLC_1.csv", "loaded", 6, 2), ("DailyReturnsLC_2.csv", "loaded", 6, 2),
                   ("DailyReturnsUSD_1.csv", "no header", 0, 0), ("DailyMVUSD_1.csv", "empty", 0, 0)}
    panel = price_panel(ri, mv, pairs=pairs)
    assert panel.where("DSCode IS NOT NULL").count() == 4
    plan = panel._jdf.queryExecution().optimizedPlan().toString()
    assert "] text" not in plan and "] parquet" in plan                              # both legs from the store


def test_new_and_changed_files_only(spark, tmpdir_uri):
    from pitpanel.sources.prices import read_price_store, update_price_store
    root, store, ledger = f"{tmpdir_uri}/in", f"{tmpdir_uri}/store", f"{tmpdir_uri}/ledger"

    def rows():
        return sorted((r.suffix, r.DSCode, r.Value, r.batch) for r in read_price_store(spark, store, ledger).collect() if r.DSCode)
    write(f"{root}/LC/DailyMVLC_1.csv", b"b\nName,DATES,c,d,e,f,g,01/01/2020\nA,X1,,,,,,5\n")
    assert update_price_store(spark, root, store, ledger) == 1
    assert update_price_store(spark, root, store, ledger) == 0
    write(f"{root}/LC/DailyMVLC_2.csv", b"b\nName,DATES,c,d,e,f,g,01/01/2020\nA,X2,,,,,,6\n")
    assert update_price_store(spark, root, store, ledger) == 1
    assert rows() == [("_1", "X1", 5.0, 1), ("_2", "X2", 6.0, 2)]
    write(f"{root}/LC/DailyMVLC_1.csv", b"b\nName,DATES,c,d,e,f,g,01/01/2020\nA,X1,,,,,,50\n")      # delivered again
    assert update_price_store(spark, root, store, ledger) == 1
    assert rows() == [("_1", "X1", 50.0, 3), ("_2", "X2", 6.0, 2)]


def test_notes_with_line_breaks_and_malformed_rows(spark, tmpdir_uri):
    from pitpanel.sources.fundamentals import BAD, fundamentals_report, files_with_line_breaks, write_fundamentals_store
    key = "C1|20201231|A|2020|"
    broken = (key + '1|"first\nsecond | ""quoted""\n\nlast"\n' + key + '2|plain 6" mark\n' + key + "3\n" + key + "4|café|extra\n"
              + key + '5|"one line"\n')
    whole = key + '6|"a|b"\n' + key + "7|" + "long " * 20_000 + "\n" + key + '8|x"y"z\n'
    write(f"{tmpdir_uri}/in/WSFVFootnote_1.txt", broken.encode("windows-1252"))
    write(f"{tmpdir_uri}/in/WSFVFootnote_2 +.txt", whole.encode("windows-1252"))
    names = files_with_line_breaks(spark, [f"{tmpdir_uri}/in/WSFVFootnote_1.txt", f"{tmpdir_uri}/in/WSFVFootnote_2 +.txt"])
    assert [n.rsplit("/", 1)[-1] for n in names] == ["WSFVFootnote_1.txt"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")                            # splits within the records
    try:
        store = write_fundamentals_store(spark, f"{tmpdir_uri}/in", f"{tmpdir_uri}/store")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    notes = store["WSFVFootnote"]
    assert {r.item_code: r.note for r in notes.collect()} == {
        1: 'first\nsecond | "quoted"\n\nlast', 2: 'plain 6" mark', 3: None, 4: "café", 5: "one line", 6: "a|b",
        7: ("long " * 20_000), 8: 'x"y"z'}
    assert {r.item_code for r in notes.where(F.col(BAD).isNotNull()).collect()} == {3, 4}
    assert sorted((r.file, r.rows, r.bad_rows) for r in fundamentals_report(store).collect()) == [
        ("WSFVFootnote_1.txt", 5, 2), ("WSFVFootnote_2 +.txt", 3, 0)]


def test_open_quotes_of_a_line():
    import re
    from pitpanel.sources.fundamentals import OPEN_AT_END
    for line, is_open in (('a|"b', True), ('a|"b"', False), ('a|"b""', True), ('a|b"', False), ('"', True), ('""', False), ('"""', True),
                          ('a|"b|c"|"d', True), ('a|"b"c|"d"', False), ('"a""b"|c', False), ('a "b|c', False), ("", False), ('x|"', True)):
        assert bool(re.match(OPEN_AT_END, line)) == is_open, line


def test_quarantine_of_unreadable_parquet(spark, tmpdir_uri):
    from pitpanel.sources.matching import parquet_files, quarantine
    sinks.write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "k int, a string").coalesce(1), f"{tmpdir_uri}/p", mode="append")
    sinks.write_parquet(spark.createDataFrame([(3, 5)], "k int, b int").coalesce(1), f"{tmpdir_uri}/p", mode="append")
    write(f"{tmpdir_uri}/p/cut off.parquet", b"PAR1 this is no footer")
    good, bad = quarantine(spark, f"{tmpdir_uri}/p")
    assert sorted(good.columns) == ["a", "b", "k"] and sorted(r.k for r in good.collect()) == [1, 2, 3]
    assert [r.file.rsplit("/", 1)[-1] for r in bad.collect()] == ["cut%20off.parquet"]
    assert sorted(r.rows for r in parquet_files(spark, f"{tmpdir_uri}/p").where("rows IS NOT NULL").collect()) == [1, 2]


def test_only_intermediate_folders_are_removed(spark, tmpdir_uri):
    from pitpanel.sources._fs import list_files, remove
    spark.range(3).write.parquet(tmpdir_uri)
    with pytest.raises(ValueError):
        remove(spark, "/root/testdata")
    remove(spark, tmpdir_uri)
    assert list_files(spark, tmpdir_uri) == []


def test_period_files_are_in_order_with_repeated_periods(spark, tmpdir_uri):
    """Periods are dealt over ranges before their rows are made: the files' order is that of a sort of all rows."""
    from pitpanel.plans import fixture_files as ff
    from pitpanel.sources._fs import list_files
    from pitpanel.plans import fixtures as fx
    t = fx.Tables(spark, "/root/testdata/sf0.001")
    t._frames["_period"] = fx.period(t).where("ord < 300").unionByName(fx.period(t).where("ord < 40"))
    want = [r.line for r in ff._pipe_line(fx.calendar_rows(fx.period(t)).orderBy("ord", "item_code", "value"), ff.SIX).collect()]
    ff.write_fundamentals_files(spark, t, tmpdir_uri, kinds=["WSCalendarPrd"])
    files = sorted(p for p, _ in list_files(spark, tmpdir_uri) if p.endswith(".txt"))
    assert [r.value for f in files for r in spark.read.text(f).collect()] == want and len(want) == 4 * 340


def test_period_kinds_are_not_written_before_their_only_use(spark):
    from pitpanel.plans import catalog
    plan = catalog.QUERIES["fundamentals_from_files"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" csv") == 2 and "Relation" in plan


def test_price_lines_are_cut_into_cells_once(spark, tmpdir_uri):
    write(f"{tmpdir_uri}/LC/DailyReturnsLC_1.csv", b"banner\nName,DATES,C,I,G,S,So,01/02/2024,02/02/2024\nCo,U1,LC,,,,DS,1,2\n")
    out = wide_prices_long(spark, tmpdir_uri)
    assert sorted((r.DSCode, r.Value) for r in out.collect()) == [("U1", 1.0), ("U1", 2.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
