"""Times the headline jobs and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driftwell.plans.registered import QUERIES  # noqa: E402
from driftwell.session import build_session  # noqa: E402

HEADLINE = [
    "region_summary",
    "narrow_time_sort",
    "word_count",
    "words_by_bucket",
    "words_per_chunk",
    "missingness",
    "duplicate_rows",
    "range_checks",
    "hard_rules",
    "unknown_zones",
    "features",
    "tips_by_payment",
    "psi",
    "jensen_shannon",
    "ks_whole_slices",
    "ks_by_chunk",
    "roc_auc_by_group",
    "stratified_folds",
    "planted_faults",
    "severity_scorecard",
    "attempt_report",
    "tick_scores",
    "tick_metrics",
    "accepted_decisions",
    "view_similarities",
    "streamed_tick_demand",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["region_summary"].job(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name].job(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_jobs_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
