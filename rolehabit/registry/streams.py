"""Structured Streaming runs over the events, each brought to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolehabit.registry.alerts import ALERT_COLUMNS, SETTINGS, joined, parsed_alerts
from rolehabit.registry.base import (
    ALERTS,
    DAILY,
    TABLES,
    WEEKLY,
    calls_from,
    fx_accounts,
    fx_roles,
    judged,
    over_views,
    registered,
    table,
)
from rolehabit.schemas import OCCURRENCE
from rolehabit.session import shared_folder
from rolehabit.settings import DAY
from rolehabit.sources.versions import InventoryVersions
from rolehabit.streaming import jobs, late
from rolehabit.streaming.progress import PROGRESS, ProgressLog


def call_stream(spark, sf_dir) -> DataFrame:
    reader = spark.readStream.schema(TABLES["events"])
    reader = reader.option("pathGlobFilter", "events.parquet")
    return calls_from(reader.parquet(sf_dir))


@registered(over_views("SELECT role_id, action, tick FROM news", DAILY))
def stream_new_actions(spark, sf_dir):
    """The replay's answer from keyed state."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    jobs.start_new_actions(
        call_stream(spark, sf_dir),
        fx_roles(spark, sf_dir),
        f"{root}/out",
        f"{root}/checkpoint",
        jobs.until_caught_up(),
        DAY,
        WEEKLY,
    ).awaitTermination()
    return spark.read.schema(OCCURRENCE).parquet(f"{root}/out").select(*OCCURRENCE.names)


@registered(over_views(f"SELECT {ALERT_COLUMNS} FROM alerts", DAILY, judged(), ALERTS))
def stream_alerts(spark, sf_dir):
    """T5: alerts of a stream, read back from the lines it wrote."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    jobs.start_alerts(
        call_stream(spark, sf_dir),
        fx_roles(spark, sf_dir),
        fx_accounts(spark, sf_dir),
        f"{root}/out",
        f"{root}/checkpoint",
        jobs.until_caught_up(),
        DAY,
        SETTINGS,
        by_tick=True,
    ).awaitTermination()
    written = spark.read.schema("value string").text(f"{root}/out/alerts")
    alerts = parsed_alerts(written.select(F.col("value")))
    return alerts.withColumn("role_actions", joined("role_actions"))


@registered(over_views("SELECT role_id, action, tick FROM news", DAILY))
def stream_role_memory(spark, sf_dir):
    """The replay's answer from state kept per role."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    jobs.start_new_actions_by_role(
        call_stream(spark, sf_dir),
        fx_roles(spark, sf_dir),
        f"{root}/out",
        f"{root}/checkpoint",
        jobs.until_caught_up(),
        DAY,
        WEEKLY,
    ).awaitTermination()
    return spark.read.schema(OCCURRENCE).parquet(f"{root}/out").select(*OCCURRENCE.names)


def arriving(spark, folder: str) -> DataFrame:
    return calls_from(spark.readStream.schema(TABLES["events"]).parquet(folder))


LATE_ROLE = "CAST(role_id AS BIGINT) % 3 = 0"
ADDED = "2024-01-16 00:00:00"

LATE_ROLES = f"""
occ AS (
  SELECT DISTINCT principal_id AS role_id, event_source || ':' || event_name AS action,
         CAST((epoch_us(event_ts) // 86400000000 + 1) * 86400 AS BIGINT) AS tick
  FROM fx_audit
  JOIN (SELECT role_id FROM fx_roles JOIN fx_accounts USING (account) WHERE status = 'ACTIVE')
    ON principal_id = role_id
  WHERE identity_type = 'AssumedRole'
    AND (NOT ({LATE_ROLE}) OR event_ts >= TIMESTAMP '{ADDED}')),"""


def _with_late_roles(spark, sf_dir, root: str, start) -> None:
    """The events in two halves, a third of the roles added to the inventory between them."""
    events, roles, accounts = table(spark, sf_dir, "events"), fx_roles(spark, sf_dir), fx_accounts(spark, sf_dir)
    versions = InventoryVersions(spark, f"{root}/inventory")
    half = F.col("ts") < F.expr(f"TIMESTAMP_NTZ '{ADDED}'")
    for some, part in ((roles.where(f"NOT ({LATE_ROLE})"), events.where(half)), (roles, events.where(~half))):
        versions.publish(some, accounts, WEEKLY)
        part.write.mode("append").parquet(f"{root}/events")
        start(arriving(spark, f"{root}/events"), versions).awaitTermination()


@registered(over_views("SELECT role_id, action, tick FROM news", LATE_ROLES + DAILY[DAILY.index("\nlagged AS") :]))
def stream_late_roles(spark, sf_dir):
    """A role counts from the micro-batch that takes in the version adding it."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def start(calls, versions):
        return jobs.start_new_actions_by_role(
            calls, versions, f"{root}/out", f"{root}/checkpoint", jobs.until_caught_up(), DAY, WEEKLY
        )

    _with_late_roles(spark, sf_dir, root, start)
    return spark.read.schema(OCCURRENCE).parquet(f"{root}/out").select(*OCCURRENCE.names)


@registered(
    over_views(
        f"SELECT {ALERT_COLUMNS} FROM alerts",
        LATE_ROLES + DAILY[DAILY.index("\nlagged AS") :],
        # a live stream groups a role's news by micro-batch, as of the last tick in it
        f"""batches AS (
          SELECT role_id, action, max(tick) OVER (PARTITION BY tick > epoch(TIMESTAMP '{ADDED}')) AS tick FROM news),
        grouped AS (SELECT DISTINCT role_id, action, tick FROM batches)""",
        judged("grouped"),
        ALERTS,
    )
)
def stream_alerts_following(spark, sf_dir):
    """T5: alerts by micro-batch, of roles that come while the stream runs."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def start(calls, versions):
        return jobs.start_alerts_following(
            calls, versions, f"{root}/out", f"{root}/checkpoint", jobs.until_caught_up(), DAY, SETTINGS
        )

    _with_late_roles(spark, sf_dir, root, start)
    written = spark.read.schema("value string").text(f"{root}/out/alerts")
    alerts = parsed_alerts(written.select(F.col("value")))
    return alerts.withColumn("role_actions", joined("role_actions"))


LATENESS = 2 * DAY
#: Which of four files an event arrives in: by its day, some a file or two later.
ARRIVAL = (
    "least(3, CASE WHEN {day} < 9 THEN 0 WHEN {day} < 17 THEN 1 WHEN {day} < 24 THEN 2 ELSE 3 END"
    " + CASE WHEN event_id % 11 = 5 THEN 1 WHEN event_id % 13 = 4 THEN 2 ELSE 0 END)"
)

ARRIVED = f"""
arrived AS (
  SELECT *, {ARRIVAL.format(day="day(event_ts)")} AS batch FROM fx_audit
  UNION ALL  -- delivered twice
  SELECT *, 1 + {ARRIVAL.format(day="day(event_ts)")} AS batch FROM fx_audit WHERE event_id % 17 = 0),
-- a micro-batch finds late what the one before it closed: the latest of those before that, less the delay
marks AS (
  SELECT n AS batch, (SELECT date_trunc('milliseconds', max(event_ts)) - INTERVAL {LATENESS} SECOND
                      FROM arrived WHERE batch < n) AS closed
  FROM range(1, 5) AS r(n)),
judged_arrivals AS (
  SELECT a.*, coalesce(event_ts <= closed, false) AS late
  FROM arrived a LEFT JOIN marks m ON m.batch = a.batch - 1)"""


def _with_late_files(spark, sf_dir, root: str) -> None:
    events, roles = table(spark, sf_dir, "events"), fx_roles(spark, sf_dir)
    arrival = F.expr(ARRIVAL.format(day="day(ts)"))
    again = events.where("event_id % 17 = 0").withColumn("batch", arrival + 1)
    arrived = events.withColumn("batch", arrival).union(again)
    with ProgressLog(spark, f"{root}/progress") as log:
        for batch in range(5):
            arrived.where(F.col("batch") == batch).drop("batch").write.mode("append").parquet(f"{root}/events")
            query = late.start_role_windows(
                arriving(spark, f"{root}/events"), roles, f"{root}/out", f"{root}/checkpoint",
                jobs.until_caught_up(), LATENESS, period=DAY,
            )
            log.wait(query)


@registered(
    over_views(
        """
SELECT role_id, tick, count(*) AS n_calls, string_agg(DISTINCT action, ',' ORDER BY action) AS role_actions
FROM (SELECT DISTINCT event_id, principal_id AS role_id, event_source || ':' || event_name AS action,
             CAST((epoch_us(event_ts) // 86400000000 + 1) * 86400 AS BIGINT) AS tick
      FROM judged_arrivals
      WHERE NOT late AND identity_type = 'AssumedRole' AND principal_id IN (SELECT role_id FROM fx_roles))
WHERE tick <= (SELECT epoch(closed) FROM marks WHERE batch = 4)
GROUP BY role_id, tick""",
        ARRIVED,
    )
)
def stream_late_files(spark, sf_dir):
    """T4: windows of event time from files out of order, over five micro-batches."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    _with_late_files(spark, sf_dir, root)
    return spark.read.parquet(f"{root}/out").withColumn("role_actions", joined("role_actions"))


@registered(
    over_views(
        """
SELECT CAST(batch AS BIGINT) AS batch_id, count(*) AS input_rows, count_if(late) AS late_rows
FROM judged_arrivals GROUP BY batch""",
        ARRIVED,
    )
)
def stream_late_counters(spark, sf_dir):
    """What each micro-batch read and found too late, kept by the listener."""
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    _with_late_files(spark, sf_dir, root)
    kept = spark.read.schema(PROGRESS).json(f"{root}/progress")
    return kept.select("batch_id", "input_rows", "late_rows")
