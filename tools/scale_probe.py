"""Scaling probe: time headline jobs on the driver tables replicated N times.

Usage: python tools/scale_probe.py SCRATCH_DIR [factor ...]
Writes orders x N (keys shifted per copy; other tables copied) under
SCRATCH_DIR/xN/, then times segment_trend and the zone count there.
Scratch data only: nothing here is registered as a query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from blockwise.plans import catalog  # noqa: E402
from blockwise.session import get_session  # noqa: E402
from blockwise.sources.tables import table  # noqa: E402

BASE = "/root/testdata/sf0.1"


def replicate(spark, out_dir: str, n: int) -> None:
    o = table(spark, BASE, "orders")
    span = o.agg(F.max("o_orderkey")).first()[0] + 1
    copies = o.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_copy"))
    copies = copies.withColumn("o_orderkey", F.col("o_orderkey") + F.col("_copy") * F.lit(span)) \
                   .drop("_copy")
    copies.write.mode("overwrite").parquet(f"{out_dir}/orders.parquet")
    for t in ("part", "nation", "region", "customer", "documents"):
        table(spark, BASE, t).write.mode("overwrite").parquet(f"{out_dir}/{t}.parquet")


def main(argv):
    scratch = argv[1]
    factors = [int(a) for a in argv[2:]] or [1, 4, 16]
    spark = get_session("local[8]", 16)
    qs = catalog.queries()
    out = {}
    for n in factors:
        d = f"{scratch}/x{n}"
        if not os.path.exists(f"{d}/orders.parquet"):
            replicate(spark, d, n)
        for key in ("segment_trend", "pip_zone_count", "fmt_topk_line"):
            qs[key](spark, d).write.format("noop").mode("overwrite").save()   # warm-up
            best = None
            for _ in range(3):
                t0 = time.perf_counter()
                qs[key](spark, d).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            out.setdefault(key, {})[f"x{n}"] = round(best, 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv)
