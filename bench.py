"""Benchmark: run the catalogue queries on one scale factor and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully executed through the ``noop`` sink (every row computed, nothing
collected). Per-query time is the median of BENCH_RUNS runs (default 1). Before timing, every
non-model query runs once on the smallest tables (BENCH_WARMUP_DIR, default sf0.001) so JIT
compilation of the generated code is not charged to whichever query happens to come first; set
BENCH_WARMUP=0 to skip it.
``BENCH_QUERIES`` (comma list) restricts the set; ``BENCH_SKIP`` removes names from it.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kestrel.plans import catalog  # noqa: E402
from kestrel.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = list(catalog.QUERIES)
    if os.environ.get("BENCH_QUERIES"):
        names = [n for n in os.environ["BENCH_QUERIES"].split(",") if n in catalog.QUERIES]
    skip = set(filter(None, os.environ.get("BENCH_SKIP", "").split(",")))
    names = [n for n in names if n not in skip]

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="kestrel-bench")
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
        for name in names:
            if name.startswith(("q36", "q37")):
                continue
            try:
                catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
            except Exception:  # noqa: BLE001 - warm-up only
                pass

    times, errors = {}, {}
    for name in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            try:
                catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as e:  # noqa: BLE001 - report and continue
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
                break
            samples.append(time.perf_counter() - t0)
        if samples:
            times[name] = round(statistics.median(samples), 3)
        print(f"[bench] {name}: {times.get(name, errors.get(name))}", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "runs": runs}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
