"""Summarise the physical plan of each catalogue query (no action beyond what building it runs).

    python tools/show_plans.py [--sf-dir /root/testdata/sf0.1] [--full out_dir] [name ...]

Per query: shuffles (Exchange), broadcasts, join strategies, scans with pushed filters or partition
filters, Arrow Python nodes, and whether a single-partition exchange or
a cartesian product appears. ``--full`` also writes each ``explain("formatted")`` to a file.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans import catalog  # noqa: E402
from kestrel.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    def n(pat):
        return len(re.findall(pat, plan))
    return {
        "exchanges": n(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)"),
        "single_partition": n(r"Exchange SinglePartition"),
        "broadcasts": n(r"BroadcastExchange"),
        "bhj": n(r"BroadcastHashJoin"),
        "smj": n(r"SortMergeJoin"),
        "cartesian": n(r"CartesianProduct|BroadcastNestedLoopJoin"),
        "pushed_filters": n(r"PushedFilters: \[[^\]]+\]"),
        "partition_filters": n(r"PartitionFilters: \[[^\]]+\]"),
        "python_nodes": n(r"MapInPandas|MapInArrow|PythonMapInArrow|ArrowEvalPython|BatchEvalPython"),
    }


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--full", default=None)
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session("local[8]", 16)
    names = args.names or [n for n in catalog.QUERIES if not n.startswith(("q36", "q37"))]
    if args.full:
        os.makedirs(args.full, exist_ok=True)
    print("| query | exchanges | single-partition | broadcast joins | sort-merge joins | cartesian | "
          "pushed filters | partition filters | python nodes |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name in names:
        df = catalog.QUERIES[name](spark, args.sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['exchanges']} | {s['single_partition']} | {s['bhj']} | {s['smj']} | {s['cartesian']} | "
              f"{s['pushed_filters']} | {s['partition_filters']} | {s['python_nodes']} |",
              flush=True)
        if args.full:
            with open(os.path.join(args.full, f"{name}.txt"), "w") as fh:
                fh.write(df._jdf.queryExecution().explainString(
                    spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))


if __name__ == "__main__":
    main()
