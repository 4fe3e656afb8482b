"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPEAT="1", BENCH_CPUS="2",
               BENCH_MEM="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["metric"] == "total_sec"
    assert set(rec["queries"]) == {"segment_trend", "zone_pair_top3", "keyword_rate", "zone_count"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
