"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is computed in full from the source tables with the ``noop``
sink (no collect to the driver). Two passes run in one session: the first
(JVM class loading, JIT, code generation) and the second. ``value`` and
``queries`` are the last pass; totals and times of both are reported as ``first_*``
and ``second_*``. ``$BENCH_PASSES=1`` runs the first pass only.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scan_raw", "reject_funnel", "p95_threshold", "rapid_succession", "quality_report",
    "stg_transactions", "mart_daily", "mart_operator", "mart_region", "mart_high_value",
    "fact_upsert", "dq_unique", "fraud_alerts", "metrics_snapshot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE

    from paylake.registry import QUERIES
    from paylake.session import build_session

    passes = int(os.environ.get("BENCH_PASSES", "2"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))

    runs = []
    for p in range(passes):
        times = {}
        for k in keys:
            t0 = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[k] = round(time.perf_counter() - t0, 3)
            print(f"# pass {p} {k}: {times[k]}s", file=sys.stderr, flush=True)
        runs.append(times)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = lambda run: round(sum(run.values()), 3)
    out = {"metric": "headline_queries_total", "value": total(runs[-1]), "unit": "sec", "queries": runs[-1]}
    for name, run in zip(("first", "second"), runs):
        out |= {f"{name}_total": total(run), f"{name}_queries": run}
    print(json.dumps(out | {"sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "passes": passes}))
    spark.stop()


if __name__ == "__main__":
    main()
