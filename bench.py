"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:

  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed to completion with the ``noop`` sink (full plan, no
driver collect); the reported time is the median of ``$BENCH_REPEATS``
(default 3) runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["comment_insights_report", "aspect_sentiment_report", "video_list", "curate_comments",
            "ngram_counts", "language_id", "prediction_rows", "video_summary"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    keys = [k for k in os.environ.get("BENCH_KEYS", ",".join(HEADLINE)).split(",") if k]

    from murmur.session import get_session
    from murmur.plans.catalog import QUERIES
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})

    times: dict[str, float] = {}
    for key in keys:
        run = lambda: QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()  # warm-up
        samples = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run()
            samples.append(time.perf_counter() - t0)
        times[key] = round(statistics.median(samples), 3)
        print(f"{key}: {times[key]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
