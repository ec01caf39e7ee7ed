"""Activity: windows, distinct calls, routing, the join to the role inventory."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rolehabit.functions.moments import (
    date_keys,
    epoch_fraction,
    iso_text,
    seconds_of,
    tick_after,
)
from rolehabit.functions.texts import has_segment, path_tail, service_of
from rolehabit.operators import activity as ops
from rolehabit.registry.base import fx_calls, fx_roles, over_views, registered
from rolehabit.settings import DAY, HOUR, Settings

HALF_PAST_MIDNIGHT = datetime(2024, 1, 15, 0, 30)


@registered(
    over_views(
        """
SELECT DISTINCT event_source, event_name, principal_id, identity_type FROM fx_audit
WHERE event_ts >= TIMESTAMP '2024-01-14 23:30:00' AND event_ts < TIMESTAMP '2024-01-15 00:30:00'"""
    )
)
def hourly_activity(spark, sf_dir):
    """Distinct calls of the trailing hour, across midnight."""
    return ops.distinct_calls(
        ops.trailing_window(fx_calls(spark, sf_dir), HALF_PAST_MIDNIGHT)
    )


@registered(
    over_views(
        """
SELECT DISTINCT event_source, event_name, principal_id, identity_type FROM fx_audit
WHERE event_ts >= TIMESTAMP '2024-01-15 00:00:00' AND event_ts < TIMESTAMP '2024-01-16 00:00:00'"""
    )
)
def hourly_activity_today_only(spark, sf_dir):
    """F4, F5 as they were: only the run's own date, and no bound above within it."""
    settings = Settings(today_only=True, bound_above=False)
    calls = ops.trailing_window(fx_calls(spark, sf_dir), HALF_PAST_MIDNIGHT, settings)
    return ops.distinct_calls(calls)


@registered(
    over_views(
        """
SELECT DISTINCT CAST((epoch_us(event_ts) // 3600000000 + 1) * 3600 AS BIGINT) AS tick,
       event_source, event_name, principal_id, identity_type
FROM fx_audit"""
    )
)
def activity_by_tick(spark, sf_dir):
    """A1 for every hourly run of the history at once."""
    return ops.distinct_calls(ops.on_ticks(fx_calls(spark, sf_dir), HOUR))


@registered(
    over_views(
        """
SELECT identity_type AS branch, count(*) AS calls, count(DISTINCT principal_id) AS principals
FROM fx_audit WHERE identity_type IN ('AssumedRole', 'Root', 'IAMUser') GROUP BY 1"""
    )
)
def identity_router(spark, sf_dir):
    """calls per branch.  Principals are counted from one row per principal,
    so a branch is never gathered in one task."""
    per_principal = (
        ops.routed(fx_calls(spark, sf_dir))
        .groupBy("branch", "principal_id")
        .agg(F.count("*").alias("n"))
    )
    return per_principal.groupBy("branch").agg(
        F.sum("n").alias("calls"), F.count("*").alias("principals")
    )


@registered(
    over_views(
        """
SELECT DISTINCT principal_id AS role_id, event_source || ':' || event_name AS action,
       CAST((epoch_us(event_ts) // 86400000000 + 1) * 86400 AS BIGINT) AS tick,
       role_name, account, role_arn
FROM fx_audit JOIN fx_roles ON principal_id = role_id
WHERE identity_type = 'AssumedRole'"""
    )
)
def role_activity_join(spark, sf_dir):
    """Distinct actions with their role, per daily run."""
    actions = ops.role_actions(ops.on_ticks(fx_calls(spark, sf_dir), DAY))
    roles = fx_roles(spark, sf_dir).select("role_id", "role_name", "account", "role_arn")
    return ops.with_roles(actions, roles)


@registered(
    over_views(
        """
SELECT event_id,
       strftime(event_ts, '%Y') AS "year", strftime(event_ts, '%m') AS "month",
       strftime(event_ts, '%d') AS "day", strftime(event_ts, '%H') AS "hour",
       strftime(event_ts - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%gZ') AS cutoff_text,
       CAST(epoch_us(event_ts) // 1000000 AS BIGINT) AS epoch,
       CAST(epoch_us(event_ts) // 1000000 AS VARCHAR) || '.' ||
         lpad(CAST(epoch_us(event_ts) % 1000000 AS VARCHAR), 6, '0') AS epoch_text,
       CAST((epoch_us(event_ts) // 3600000000 + 1) * 3600 AS BIGINT) AS tick,
       CAST(epoch_us(event_ts) // 1000000 + 90 * 86400 AS BIGINT) AS ttl,
       string_split(event_source, '.')[1] AS service, upper(event_name) AS shouted
FROM fx_audit"""
    )
)
def time_and_text_functions(spark, sf_dir):
    """C1–C3, C13–C17, P5, P8 over every event."""
    ts = F.col("event_ts")
    micros = ts.cast("timestamp")
    return fx_calls(spark, sf_dir).select(
        "event_id",
        *[value.alias(name) for name, value in date_keys(ts).items()],
        iso_text(ts - F.expr("INTERVAL 1 HOUR")).alias("cutoff_text"),
        seconds_of(ts).alias("epoch"),
        epoch_fraction(micros).cast("string").alias("epoch_text"),
        tick_after(ts, HOUR).alias("tick"),
        (seconds_of(ts) + 90 * DAY).alias("ttl"),
        F.split_part("event_source", F.lit("."), F.lit(1)).alias("service"),
        F.upper("event_name").alias("shouted"),
    )


@registered(
    over_views(
        """
SELECT role_id, regexp_extract(role_arn, '.*/(.*)', 1) AS tail,
       list_contains(string_split(role_arn, '/'), 'aws-service-role') AS linked,
       contains(lower(role_name), '#0000000') AS contains_token,
       role_id IN ('1', '20', '300') AS listed,
       string_split(role_arn || ':x', ':')[1] AS service,
       replace(principal_json, '"', '') AS unquoted,
       len(string_split(role_arn, '/')) AS segments
FROM fx_roles"""
    )
)
def role_text_functions(spark, sf_dir):
    """C2–C8, C18 over every role."""
    arn = F.col("role_arn")
    return fx_roles(spark, sf_dir).select(
        "role_id",
        path_tail(arn).alias("tail"),
        has_segment(arn, "aws-service-role").alias("linked"),
        F.lower("role_name").contains("#0000000").alias("contains_token"),
        F.col("role_id").isin("1", "20", "300").alias("listed"),
        service_of(arn).alias("service"),
        ops.plain(F.col("principal_json")).alias("unquoted"),
        F.size(F.split(arn, "/")).cast("bigint").alias("segments"),
    )
