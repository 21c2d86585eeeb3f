"""Benchmark the headline report queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (timed runs per query, default 3), BENCH_QUERIES (comma list).
Each query is run once to warm (adapter tables land in memory on first use), then timed
BENCH_REPEAT times end to end: plan construction + full execution into a no-op sink.
Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cost_by_area_modality", "cost_by_body_area", "oncology_final",
    "alert_report", "alert_statistics", "response_buckets",
    "action_completion", "action_completion_filtered",
    "global_sequence", "nearest_within_window", "split_param",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from caresight.catalog import QUERIES
    from caresight.session import build_session
    from caresight.sources.tables import release_staged
    spark = build_session()
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = QUERIES[name]

        def run() -> None:
            release_staged()  # every timed run recomputes its intermediates
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

        run()  # warm
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
        rows[name] = fn(spark, sf_dir).count()
        print(f"# {name}: {timings[name]}s rows={rows[name]}", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_median_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "rows": rows,
                      "sf": float(m.group(1)) if m else sf_dir, "repeat": repeat,
                      "cpus": int(os.environ.get("BENCH_CPUS", "8"))}))


if __name__ == "__main__":
    main()
