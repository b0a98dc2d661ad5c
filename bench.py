"""Time the registered queries on local[$BENCH_CPUS] and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from postern.plans.queries import QUERIES
from postern.session import local_session

# The jobs end to end first, then single operators.
HEADLINE = [
    "routed_events",
    "outcome_counts",
    "routed_entries",
    "settled_events",
    "task_requests",
    "journal_updates",
    "current_journal",
    "retry_enqueue",
    "repair_rejections",
    "journal_snapshot",
    "enrich_journal",
    "resolve_identities",
    "map_codes",
    "no_open_task",
    "decode_events",
    "deadline_auto",
    "dedup_in_batch",
    "stream_route",
    "stream_enrich",
    "stream_retry",
]


# Each query is built and run this often; the faster run counts.
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="postern-bench")
    # One untimed run loads classes and compiles the shared code paths.
    QUERIES["outcome_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds_best_of_2",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
