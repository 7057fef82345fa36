"""Benchmark: run the headline pipelines at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed to completion with a no-op sink (``write.format("noop")``), which runs
the whole plan without collecting rows to the driver.  Each query runs once to warm the JVM
(class loading, code generation), then twice timed; the faster timed run is reported (the
host is shared, so single runs vary by tens of percent).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kestrel.plans.catalog import CATALOG, runner  # noqa: E402
from kestrel.session import local_session  # noqa: E402

HEADLINE = [
    "unified_assessments", "assessments_elementary", "curriculum_assessments", "verified_assessments",
    "interim_ica", "sbac_tabular", "cast_tabular", "elpac_growth", "meal_applications_best", "meal_coverage_roster",
    "meals_with_application", "enrollment_demographics", "ixl_scores", "pear_best_submission", "grade_audit",
    "check_sbac_duplicates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [n for n in HEADLINE if n in CATALOG]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="kestrel-bench")
    times = {}
    for name in names:
        runs = []
        for _ in range(3):
            t = time.perf_counter()
            runner(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        times[name] = round(min(runs[1:]), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
