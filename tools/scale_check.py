"""Growth of run time with data: the sf0.1 company-periods replicated k times
(each copy a distinct company, so key cardinality grows with the data), then
the fundamentals chain and Panel C. Prints one line per k.

    python tools/scale_check.py [k ...]
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from pitpanel import get_spark  # noqa: E402
from pitpanel.plans import fixtures as fx  # noqa: E402
from pitpanel.plans import fundamentals as fu  # noqa: E402
from pitpanel.plans import lag  # noqa: E402


def replicate(df, k: int, parts: int):
    return (df.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(k))))
            .repartition(parts)            # spread the copies (the source files have one row group)
            .withColumn("ws_id", F.concat("ws_id", F.lit("_"), F.col("_r").cast("string")))
            .drop("_r"))


def main():
    ks = [int(x) for x in sys.argv[1:]] or [1, 4, 16]
    spark = get_spark("local[8]", shuffle_partitions=16)
    t = fx.Tables(spark, "/root/testdata/sf0.1")
    for k in ks:
        parts = max(8, 8 * k // 4)
        facts = replicate(fx.facts(t), k, parts)
        merged = fu.merged(facts, replicate(fx.calendar(t), k, parts), replicate(fx.reported(t), k, parts))
        q = lag.panel_c(lag.lag_features(fu.final_no_cols(merged)))
        q.write.format("noop").mode("overwrite").save()              # warm-up
        t0 = time.perf_counter()
        q.write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        print(f"k={k:3d} facts={600_000 * k:>10,d} rows  seconds={dt:6.2f}  us/fact-row={dt / (600_000 * k) * 1e6:5.2f}")


if __name__ == "__main__":
    main()
