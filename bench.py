"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores. Each query is
run to the end into a sink that drops its rows. The whole list is run
``BENCH_WARM`` times before anything is timed, so that queries at its head do not
pay for the start of the session; then each runs ``BENCH_RUNS`` times, of which the
fastest counts. ``built`` is the part of it that goes by before the query returns
its frame: planning, and staged work of loads and streams.
"""

from __future__ import annotations

import json
import os
import sys
import time

from orderloom.registry.queries import QUERIES
from orderloom.session import local_session

HEADLINE = (
    "report_channel_summary",
    "report_online",
    "report_offline",
    "report_inventory",
    "report_sku_online",
    "report_purchases",
    "report_channel_summary_week",
    "upsert_detail",
    "upsert_orders",
    "append_new",
    "latest_per_key",
    "pivot_daily_long",
    "flatten_orders",
    "page_completeness",
    "hourly_spine_counts",
    "stream_hourly_counts",
    "stream_upsert",
)


def seconds(spark, folder: str, name: str) -> tuple[float, float]:
    begun = time.perf_counter()
    frame = QUERIES[name](spark, folder)
    built = time.perf_counter() - begun
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun, built


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm, runs = int(os.environ.get("BENCH_WARM", "2")), int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    for _ in range(warm):
        for name in names:
            seconds(spark, folder, name)
    best = {name: min(seconds(spark, folder, name) for _ in range(runs)) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(total for total, _ in best.values()), 3),
                "unit": "sec",
                "queries": {name: round(total, 3) for name, (total, _) in best.items()},
                "built": {name: round(built, 3) for name, (_, built) in best.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
