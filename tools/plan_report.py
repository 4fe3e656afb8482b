"""Summarise the physical plan of every catalogue query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
For each query: scanned tables with the columns read and pushed filters,
shuffle exchanges, join strategies, window limits and Python evaluation.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blockwise.plans import catalog  # noqa: E402
from blockwise.session import get_session  # noqa: E402

JOINS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct")


def summarise(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan()
    text = plan.toString()
    jvm = df.sparkSession.sparkContext._jvm
    formatted = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scans = []
    for block in re.split(r"\n\(\d+\) ", formatted):
        if block.startswith("Scan parquet"):
            loc = re.search(r"Location: \w+ \[file:[^\]]*/([\w]+)\.parquet\]", block)
            schema = re.search(r"ReadSchema: struct<([^>]*)>", block)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", block)
            cols = [c.split(":")[0] for c in schema.group(1).split(",")] if schema else []
            scans.append((loc.group(1) if loc else "?", cols, pushed.group(1) if pushed else ""))
    return {
        "scans": scans,
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                    r"Exchange SinglePartition|Exchange RoundRobin", text)),
        "broadcasts": text.count("BroadcastExchange"),
        "joins": {j: text.count(j) for j in JOINS if j in text},
        "window_limit": "WindowGroupLimit" in text,
        "python": any(p in text for p in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    print("# Physical plans of the catalogue queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf_dir}` (initial adaptive plans; "
          "AQE may coalesce partitions or convert a join at run time).\n")
    print("| Query | Tables read (columns) | Pushed filters | Shuffles | Broadcasts | Joins | "
          "Top-k limit | Python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in catalog.queries().items():
        s = summarise(fn(spark, sf_dir))
        tables = "; ".join(f"{t}({', '.join(c)})" for t, c, _ in s["scans"])
        pushed = "; ".join(p for _, _, p in s["scans"] if p)
        joins = ", ".join(f"{k} x{v}" for k, v in s["joins"].items()) or "-"
        print(f"| `{name}` | {tables} | {pushed or '-'} | {s['exchanges']} | {s['broadcasts']} | "
              f"{joins} | {'yes' if s['window_limit'] else '-'} | {'YES' if s['python'] else 'no'} |")


if __name__ == "__main__":
    main(sys.argv)
