"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed fully with the ``noop`` sink (no collect to the
driver); the time is the best of ``$BENCH_REPEATS`` runs (default 3) after
one warm-up query that starts the JVM and reads the Parquet footers.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from qualmark.plans.queries import QUERIES  # noqa: E402
from qualmark.session import clear_scratch, local_session  # noqa: E402

HEADLINE = [
    "null_count", "null_alerts", "compute_null_threshold", "freq_count", "freq_threshold", "freq_alerts",
    "rule_min_max", "sample_rows", "page_by_row_number", "string_scores", "score_summary", "kde_scores",
    "score_day", "kde_shifted", "string_scores_long", "number_rows", "value_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, app="qualmark-bench")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeats):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        clear_scratch(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
