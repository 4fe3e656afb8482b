"""Benchmark the four headline jobs.

Runs each job at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is materialised fully (every result row is produced and written
to a no-op sink), once to warm up the JVM and the parquet footers, then timed
as the best of ``$BENCH_REPEAT`` runs (default 7).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blockwise.plans import catalog  # noqa: E402
from blockwise.session import get_session  # noqa: E402

HEADLINE = {
    "segment_trend": "segment_trend",      # job A
    "zone_pair_top3": "fmt_topk_line",     # job B
    "keyword_rate": "zone_rate",           # job C
    "zone_count": "pip_zone_count",        # job D
}


def _run(df) -> None:
    # The "noop" sink computes every row without collecting to the driver.
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "7"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        app_name="blockwise-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    qs = catalog.queries()
    times = {}
    for name, key in HEADLINE.items():
        _run(qs[key](spark, sf_dir))
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            _run(qs[key](spark, sf_dir))
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
