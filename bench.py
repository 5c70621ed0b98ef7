"""Seconds per headline query, as one JSON line.

Each query runs twice against the whole tables into Spark's ``noop`` sink; the
second run counts, so that code generation and class loading stay out.
"""

from __future__ import annotations

import json
import os
import sys
import time

from vitalgrid.plans.catalog import QUERIES
from vitalgrid.session import local_session

HEADLINE = (
    "iso_minute time_of_day route_files arrival_json parse_preamble parse_marker_header parse_bbi_pairs "
    "decode_cascade clean_heart_rate clean_step_dedup file_audit sleep_expand sleep_unit_inference align_metrics "
    "align_fanout align_latest align_cleaned bbi_derive bbi_diff hrv_summary hrv_no_diff hrv_merge survey_normalise "
    "survey_upsert batch_status batch_first_complete batch_outcomes stream_dedup stream_batch_status"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in names:
        for _ in range(2):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "headline query seconds, sum of warm runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
