"""Time the headline queries: one warm-up, then the median of three runs, each forced in full.

Jobs and streams write everything again in every run, so they are timed once. Names on the command
line choose other queries, ``all`` every one. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import BUILDS  # noqa: E402
from curbsight.session import local_session  # noqa: E402

HEADLINE = ("gold_", "aq_q", "tr_q", "saved_", "silver_air_valid", "cdc_dedup_latest", "st_incremental", "job_air")
WRITING = ("rt_", "st_", "job_", "src_jsonl", "src_parquet_table", "cdc_decode", "cdc_flatten")


def timed(spark, build, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = set(sys.argv[1:])
    spark = local_session(cores, app="bench")
    seconds: dict[str, float] = {}
    for name, build in BUILDS.items():
        if "all" not in chosen and not (name in chosen if chosen else name.startswith(HEADLINE)):
            continue
        if name.startswith(WRITING):
            seconds[name] = round(timed(spark, build, sf_dir), 3)
            continue
        timed(spark, build, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, build, sf_dir) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
