"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of test tables, ``BENCH_CPUS`` the local cores. Each query runs
once to warm up and is timed on the second run, result rows included.
"""

from __future__ import annotations

import json
import os
import time

from checks.registry import queries
from tessera.session import local_session

HEADLINE = [
    "fuse_persons",
    "incomplete_persons",
    "persons_load",
    "persons_by_city_job",
    "group_records",
    "group_records_by_value",
    "components_incomplete",
    "raw_upsert_merge",
    "route_fragments",
    "ttl_dedup_events",
    "stream_ttl_dedup",
    "rolling_mean_1m",
    "duration_histogram",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    known, seconds = queries(), {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": cpus,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
