"""Time the headline queries; prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Every query is run once to warm up, then
timed from building the plan (with its statistics jobs) to the last row.
"""

from __future__ import annotations

import json
import os
import time

from tidelane.plans.catalog import QUERIES
from tidelane.session import local_session

HEADLINE = [
    "asof_align", "asof_join", "asof_join_by_key", "regularize", "fill_secondary", "time_grid",
    "flag_intervals_closed", "flag_intervals_closed_swept", "period_extracts", "bucket_first", "bucket_mean",
    "bucket_by_type", "resample_mean_join", "lag_diff", "previous_row", "find_gaps", "regularity_report",
    "series_completeness", "position_jumps", "rolling_outliers", "rolling_deviation", "validate_ranges",
    "missing_report", "quality_scores", "describe_series", "corrected_ph", "log_rows", "patch_gps", "patch_tsg",
    "combine_underway", "process_underway", "audit_series",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
