"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then ``BENCH_RUNS`` times; its figure is the
median.  Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rolehabit.registry import QUERIES  # noqa: E402
from rolehabit.session import build_session  # noqa: E402

HEADLINE = (
    "hourly_activity",
    "activity_by_tick",
    "identity_router",
    "role_activity_join",
    "decisions_tick",
    "baseline_upsert",
    "baseline_expiry_replay",
    "baseline_sessions",
    "replay_daily_7d",
    "replay_hourly_90d",
    "replay_in_blocks",
    "role_new_action_sets",
    "trust_classification",
    "suppression_reasons",
    "alerts_full",
    "alert_envelope",
)
# Jobs with writes and start-up of their own: timed once, after the others.
ONCE = (
    "json_ingest_roundtrip",
    "audit_partition_scan",
    "baseline_snapshot",
    "run_counters",
    "tick_lifecycle",
    "stream_new_actions",
    "stream_role_memory",
    "stream_alerts",
)


def seconds(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    seconds(QUERIES["identity_router"], spark, sf_dir)  # a cold JVM is not the first query's fault
    for name in HEADLINE:
        seconds(QUERIES[name], spark, sf_dir)
        took[name] = statistics.median(
            seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)
        )
    for name in ONCE:
        took[name] = seconds(QUERIES[name], spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in took.items()},
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
