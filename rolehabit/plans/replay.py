"""History in one pass: all ticks at once, without a stored baseline."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolehabit.functions.moments import as_utc, epoch_of, moment
from rolehabit.operators import activity, alerts, novelty
from rolehabit.plans.tick import roles_in_scope
from rolehabit.settings import HOUR, Settings
from rolehabit.sources.baseline import BaselineStore
from rolehabit.sources.inventory import selected_accounts


def occurrences(
    calls: DataFrame, roles: DataFrame, period: int = HOUR, settings: Settings = Settings()
) -> DataFrame:
    """Distinct ``(role_id, action, tick)`` for runs ``period`` seconds apart.

    Placed by role and action.  If the inventory is too large to broadcast, rows
    come out of the join placed by role alone, which later steps would make do
    with: a role doing a third of everything would stay one task.  Saying so here
    also lets adaptive execution split that role inside the join.
    """
    actions = activity.role_actions(activity.on_ticks(activity.in_scope(calls, settings), period))
    return activity.of_known_roles(actions, roles).repartition("role_id", "action")


def replay(
    calls: DataFrame, roles: DataFrame, period: int = HOUR, settings: Settings = Settings()
) -> DataFrame:
    """New ``(role_id, action, tick)`` of every tick of the history given."""
    return novelty.first_or_lapsed(occurrences(calls, roles, period, settings), settings.ttl)


def replay_alerts(
    calls: DataFrame,
    roles: DataFrame,
    accounts: DataFrame,
    period: int = HOUR,
    settings: Settings = Settings(),
) -> DataFrame:
    """The alerts those ticks would have sent."""
    accounts = selected_accounts(accounts, settings)
    roles = roles_in_scope(roles, accounts)
    new = replay(calls, roles, period, settings)
    return alerts.alert_records(alerts.judged(new, roles, settings), accounts)


def warm_up(
    calls: DataFrame,
    roles: DataFrame,
    store: BaselineStore,
    run_ts: datetime,
    period: int = HOUR,
    settings: Settings = Settings(),
) -> int:
    """Fill an empty store from history without alerting, so that the first live
    tick does not report everything.  Returns the version.

    What has expired by ``run_ts`` is not read.  A store that holds something is
    refused: history up to ``run_ts`` would replace what later runs have learned.
    """
    if store.latest():
        raise ValueError("the baseline already holds a snapshot; warm up an empty one")
    run_epoch = epoch_of(run_ts)
    dtype = calls.schema["event_ts"].dataType.simpleString()
    first = as_utc(run_ts) - timedelta(seconds=settings.ttl + period)
    calls = activity.in_scope(calls, settings).where(
        (F.col("event_ts") >= moment(first, dtype)) & (F.col("event_ts") < moment(as_utc(run_ts), dtype))
    )
    actions = activity.role_action_rows(activity.on_ticks(calls, period))
    learned = activity.of_known_roles(
        novelty.baseline_as_of(actions, run_epoch, settings.ttl), roles
    )
    version = store.latest() + 1
    store.write(learned, version)
    store.publish(version, run_epoch)
    return version
