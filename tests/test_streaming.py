import os

from pitpanel.session import local_path, work_dir
from pitpanel.streaming.ingest import ingest_items


def write(path, data: bytes):
    p = local_path(path)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(data)


def test_incremental_ingest_only_new_files(spark):
    src, out, ck = work_dir(spark, "src"), work_dir(spark, "out"), work_dir(spark, "ck")
    write(f"{src}/WSCalendarPrd_1.txt", b"C1|20201231|A|2020|55350|d20201231\nC1|20201231|A|2020|55555|2020\n")
    ingest_items(spark, src, "WSCalendarPrd", out, ck).awaitTermination()
    assert spark.read.parquet(out).count() == 2
    ingest_items(spark, src, "WSCalendarPrd", out, ck).awaitTermination()      # nothing new
    assert spark.read.parquet(out).count() == 2
    write(f"{src}/WSCalendarPrd_2.txt", b"C2|20211231|A|2021|55350|d20211231\n")
    write(f"{src}/WSFV_1.txt", b"C2|20211231|A|2021|2003|5\n")                  # other kind: ignored
    write(f"{src}/WSCalendarPrdFootnote_1.txt", b"C2|20211231|A|2021|55350|note\n")   # longer kind: ignored
    ingest_items(spark, src, "WSCalendarPrd", out, ck).awaitTermination()
    df = spark.read.parquet(out)
    assert df.count() == 3 and sorted(r[0] for r in df.select("item_code").distinct().collect()) == [55350, 55555]
