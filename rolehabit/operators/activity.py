"""From audit records to distinct actions of known roles."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolehabit.functions.moments import as_utc, epoch_of, moment, tick_after
from rolehabit.functions.texts import action_key, plain
from rolehabit.settings import IDENTITY_TYPES, ROLE_BRANCH, Settings
from rolehabit.sources.audit import spanned_days

ACTIVITY = ("event_source", "event_name", "principal_id", "identity_type")


def calls_of(records: DataFrame, *kept: str) -> DataFrame:
    """The four fields of interest plus account, region and time, and columns to keep."""
    partitions = [c for c in ("year", "month", "day", "hour") if c in records.columns]
    return records.select(
        "account",
        "region",
        "event_ts",
        *partitions,
        F.col("eventSource").alias("event_source"),
        F.col("eventName").alias("event_name"),
        F.col("userIdentity.sessionContext.sessionIssuer.principalId").alias("principal_id"),
        F.col("userIdentity.type").alias("identity_type"),
        *kept,
    )


def in_scope(calls: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Calls of the regions wanted; the same for ticks, replay, warm-up and streams."""
    if settings.regions and "region" in calls.columns:
        return calls.where(F.col("region").isin(*settings.regions))
    return calls


def on_run_dates(calls: DataFrame, run_ts: datetime, settings: Settings) -> DataFrame:
    """Partition filter: the dates and hours the window spans."""
    first = as_utc(run_ts) - timedelta(seconds=settings.window)
    days = spanned_days(run_ts, settings)
    dates = [
        (F.col("year") == f"{d:%Y}") & (F.col("month") == f"{d:%m}") & (F.col("day") == f"{d:%d}")
        for d in days
    ]
    wanted = dates[0]
    for test in dates[1:]:
        wanted = wanted | test
    kept = calls.where(wanted)
    if "hour" in calls.columns:
        hour = F.concat("year", "month", "day", "hour")
        kept = kept.where(hour >= f"{first:%Y%m%d%H}")
    return kept


def trailing_window(
    calls: DataFrame, run_ts: datetime, settings: Settings = Settings()
) -> DataFrame:
    """Calls since ``run_ts - window``.

    The cutoff is cut to its second: event times carry whole seconds, and the
    text comparison this stands for keeps the cutoff's own second.
    """
    run_ts = as_utc(run_ts)
    cutoff = (run_ts - timedelta(seconds=settings.window)).replace(microsecond=0)
    midnight = run_ts.replace(hour=0, minute=0, second=0, microsecond=0)
    dtype = calls.schema["event_ts"].dataType.simpleString()
    event_ts = F.col("event_ts")
    if "year" in calls.columns:
        calls = on_run_dates(calls, run_ts, settings)
    if settings.today_only:
        cutoff = max(cutoff, midnight)
    kept = calls.where(event_ts >= moment(cutoff, dtype))
    if settings.bound_above:
        kept = kept.where(event_ts < moment(run_ts, dtype))
    elif settings.today_only:
        kept = kept.where(event_ts < moment(midnight + timedelta(days=1), dtype))
    return in_scope(kept, settings)


def at_tick(calls: DataFrame, run_ts: datetime) -> DataFrame:
    return calls.withColumn("tick", F.lit(epoch_of(run_ts)).cast("bigint"))


def on_ticks(calls: DataFrame, period: int) -> DataFrame:
    """Put on every call the run that sees it, for runs ``period`` seconds apart."""
    return calls.withColumn("tick", tick_after(F.col("event_ts"), period))


def distinct_calls(calls: DataFrame) -> DataFrame:
    """Distinct activity per tick (and account), texts cleaned.

    The aggregate drops repeats before the shuffle, which is then keyed by the
    whole row, so a busy principal is spread over all tasks.
    """
    keys = [c for c in ("account", "tick") if c in calls.columns]
    return calls.select(*keys, *[plain(F.col(c)).alias(c) for c in ACTIVITY]).distinct()


def branch() -> Column:
    """The analysis a call is routed to; NULL for other identity types."""
    return F.when(F.col("identity_type").isin(*IDENTITY_TYPES), F.col("identity_type"))


def routed(calls: DataFrame) -> DataFrame:
    return calls.where(F.col("identity_type").isin(*IDENTITY_TYPES)).withColumn(
        "branch", branch()
    )


def role_calls(calls: DataFrame) -> DataFrame:
    return calls.where(F.col("identity_type") == ROLE_BRANCH)


def role_action_rows(calls: DataFrame, *kept: str) -> DataFrame:
    """``(principal_id as role_id, action)`` of role calls, with repeats, and with
    the tick and account where the calls carry them, and columns to keep.

    Role calls without a principal can match no role; leaving them out here keeps
    their one empty key from gathering in a single task of the join.
    """
    carried = [c for c in ("account", "tick") if c in calls.columns]
    principal = plain(F.col("principal_id"))
    action = action_key(plain(F.col("event_source")), plain(F.col("event_name")))
    return (
        role_calls(calls)
        .where(principal != "")
        .select(principal.alias("role_id"), action.alias("action"), *carried, *kept)
    )


def role_actions(calls: DataFrame) -> DataFrame:
    return role_action_rows(calls).distinct()


def of_known_roles(actions: DataFrame, roles: DataFrame) -> DataFrame:
    """Actions whose principal is in the role inventory (of the same account,
    where the actions carry one).  Role details are joined later, to the few
    new actions; a semi join keeps this one narrow and free of duplicates.

    No broadcast is forced: Spark broadcasts the ids when their size allows and
    otherwise sorts and merges, splitting skewed partitions.
    """
    keys = ["role_id"] + (["account"] if "account" in actions.columns else [])
    known = actions.join(roles.select(*keys), keys, "left_semi")
    return known.drop("account")


def with_roles(actions: DataFrame, roles: DataFrame) -> DataFrame:
    keys = ["role_id"] + (["account"] if "account" in actions.columns else [])
    return actions.join(roles, keys)


def unknown_principals(actions: DataFrame, roles: DataFrame) -> DataFrame:
    """Actions of principals in no inventory: neither learned nor reported, only counted."""
    keys = ["role_id"] + (["account"] if "account" in actions.columns else [])
    return actions.join(roles.select(*keys), keys, "left_anti")
