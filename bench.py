"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one cold run, then ``$BENCH_REPEAT`` warm runs (default
5); the reported time is the warm median. Every run executes the whole plan
into the ``noop`` sink (nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("report_view", "report_view_chain", "fraud_report", "scd2_merge",
            "latest_day", "rule_cities", "rule_brute_force", "report_view_history",
            "report_view_as_of", "lag_chain")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]

    from cardwatch.config import build_session
    from cardwatch.plans.registry import queries

    spark = build_session(f"local[{cpus}]", app="cardwatch-bench",
                          shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    qs = queries()
    times, cold = {}, {}
    for name in only or HEADLINE:
        build = qs[name]
        t0 = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        cold[name] = round(time.perf_counter() - t0, 3)
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_warm_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
        "python": platform.python_version(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
