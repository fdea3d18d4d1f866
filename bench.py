"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Every query runs once to warm up and is then timed BENCH_RUNS times (default 3);
the median counts.  Results are materialized in full, without a sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kpiloom.registry import QUERIES  # noqa: E402
from kpiloom.session import build_session  # noqa: E402

HEADLINE = [
    "entity_baselines",
    "entity_baselines_hot",
    "deviation_features",
    "incident_slots",
    "batch_quality",
    "before_rows",
    "after_rows",
    "diagnose",
    "cause_by_cell",
    "outlier_report",
    "quality_score",
    "clean",
    "timestamp_issues",
    "stratified_split",
    "roc_auc",
    "kpi_improvements",
    "blast_radius",
    "verdict_answers",
    "assemble_plans",
    "similar_cases",
    "recommendations",
    "incident_run",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
