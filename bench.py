"""Time the headline queries; prints one JSON line.

Each query runs to completion through a sink that discards its rows; the value
is the sum over queries of the median of the timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rosterline import staging
from rosterline.bindings import catalog
from rosterline.session import local_session

# One query per operator family, and the plans with the longest join chains.
HEADLINE = [
    "overlap_pairs", "count_by_key", "meetings_flat", "not_in_correlated", "apply_top1", "adjacent_versions", "prefix_lookup",
    "distinct_per_key", "dedupe_keep_min", "reconcile_rows", "html_rows_per_key", "latest_per_key", "desired_state", "set_compare",
    "transitive_closure", "keyed_stage", "upsert_settings", "sync_changes", "repair_versions", "guarded_purge", "bounded_backfill",
    "campus_section_meetings_student", "campus_conflicts_student", "campus_attendance_not_taken", "campus_late_registrant_absences",
    "campus_weekly_schedule", "campus_queue_messages", "campus_phone_country", "campus_reconcile_tax_forms",
]


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, shuffle_partitions=int(cores) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    # Untimed: JVM and generated-code warm-up.
    catalog.QUERIES["meetings_flat"](spark, path).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in chosen:
        taken = []
        for _ in range(runs):
            with staging.run(spark):  # what a query stages goes with its run, outside the timed part
                start = time.perf_counter()
                catalog.QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
    scale = os.path.basename(path.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
