"""Activity of roles by hour of the events themselves, with a bound on lateness.

Hours are windows of event time.  A window is written once, when the watermark (the latest
event seen less ``delay``) has passed its end, so files may arrive in any order within
the delay.  What comes later is left out and counted exactly: repeated events are dropped
first, by their id and row by row, so the count of what that step finds too late is a
count of events (an aggregate would count groups).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rolehabit.operators import activity
from rolehabit.settings import HOUR, Settings


def role_windows(
    calls: DataFrame, roles: DataFrame, delay: int, event_id: str, period: int = HOUR, settings: Settings = Settings()
) -> DataFrame:
    """Stream of (role_id, tick, n_calls, role_actions): one row per role and window.

    An event that is delivered again within the watermark counts once; events without an
    id all count.  Counts and sets are partial aggregates before they are shuffled, so a
    busy role is no hot key.
    """
    own = F.coalesce(F.col(event_id).cast("string"), F.expr("uuid()"))
    timed = activity.in_scope(calls, settings).withColumns({"event_ts": F.col("event_ts").cast("timestamp"), "_event": own})
    once = timed.withWatermark("event_ts", f"{delay} seconds").dropDuplicatesWithinWatermark(["_event"])
    rows = activity.role_action_rows(once, "event_ts")
    known = activity.of_known_roles(rows, roles)
    grouped = known.groupBy(F.window("event_ts", f"{period} seconds").alias("span"), "role_id").agg(
        F.count("*").alias("n_calls"), F.array_sort(F.collect_set("action")).alias("role_actions")
    )
    return grouped.select("role_id", F.unix_seconds("span.end").alias("tick"), "n_calls", "role_actions")


def start_role_windows(
    calls: DataFrame,
    roles: DataFrame,
    output: str,
    checkpoint: str,
    trigger: dict,
    delay: int,
    event_id: str = "event_id",
    period: int = HOUR,
    settings: Settings = Settings(),
    name: str = "role_windows",
) -> StreamingQuery:
    """Closed windows to a Parquet table, each exactly once.  Read it as a table, not by
    its files: the sink's log says which files count."""
    return (
        role_windows(calls, roles, delay, event_id, period, settings)
        .writeStream.outputMode("append")
        .format("parquet")
        .queryName(name)
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
