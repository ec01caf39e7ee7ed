"""One run of the hourly job, over all accounts at once.

The order of effects makes a failed run repeatable: activity, decisions, alerts
and the next snapshot are written first, and only then does the snapshot become
current.  Repeating the run from the same version gives the same alerts; no
failure loses one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rolehabit.functions.moments import epoch_of, moment
from rolehabit.operators import activity, alerts, novelty
from rolehabit.settings import IDENTITY_TYPES, Settings
from rolehabit.sinks.emission import alert_lines, run_folder, write_lines
from rolehabit.sinks.tables import written
from rolehabit.sources.baseline import BaselineStore
from rolehabit.sources.inventory import selected_accounts, usable_roles


@dataclass(frozen=True)
class TickResult:
    version: int
    alerts_folder: str
    counters: dict[str, int]


def roles_in_scope(roles: DataFrame, accounts: DataFrame) -> DataFrame:
    """Roles with a readable policy in the selected accounts."""
    return usable_roles(roles).join(accounts.select("account"), "account", "left_semi")


def run_tick(
    calls: DataFrame,
    roles: DataFrame,
    accounts: DataFrame,
    store: BaselineStore,
    output: str,
    run_ts: datetime,
    settings: Settings = Settings(),
    from_version: int | None = None,
    windowed: bool = True,
) -> TickResult:
    """Report what is new at ``run_ts`` and move the baseline on.

    A run that has already published its snapshot is left as it is, so that a
    retry cannot replace its alerts; ``from_version`` says to run it regardless.

    ``output`` is a folder all executors share.  Intermediate results are written
    there and read back: the log is scanned once, and a lost executor costs a
    re-read of small files instead of that scan.  ``windowed=False`` takes all
    calls given, for micro-batches, which hold each call once.
    """
    run_epoch = epoch_of(run_ts)
    if from_version is None and run_epoch in store.runs():
        return TickResult(store.runs()[run_epoch], run_folder(output, "alerts", run_epoch), {})
    version = store.latest() if from_version is None else from_version
    baseline = store.load(version)
    accounts = selected_accounts(accounts, settings)
    roles = roles_in_scope(roles, accounts)

    window = activity.trailing_window(calls, run_ts, settings) if windowed else calls
    scanned = Observation(f"activity {run_epoch}")
    seen_calls = activity.distinct_calls(activity.at_tick(window, run_ts)).observe(
        scanned,
        F.count(F.lit(1)).alias("distinct_calls"),
        *[
            F.count_if(F.col("identity_type") == name).alias(f"branch_{name}")
            for name in IDENTITY_TYPES
        ],
    )
    seen_calls = written(seen_calls, run_folder(output, "activity", run_epoch))

    # without the tick, which is the same everywhere, the distinct rows are already
    # placed by the baseline's key
    all_actions = Observation(f"actions {run_epoch}")
    actions = activity.role_actions(seen_calls.drop("tick")).observe(
        all_actions, F.count(F.lit(1)).alias("principal_actions")
    )
    seen = activity.at_tick(activity.of_known_roles(actions, roles), run_ts)
    judged_actions = Observation(f"decisions {run_epoch}")
    decisions = novelty.decide(seen, baseline, run_epoch).observe(
        judged_actions,
        F.count(F.lit(1)).alias("role_actions"),
        F.count_if("is_new").alias("new_actions"),
    )
    decisions = written(decisions, run_folder(output, "decisions", run_epoch))

    new = decisions.where("is_new").drop("is_new")
    concerned = alerts.roles_with_news(roles, new)
    records = alerts.alert_records(alerts.judged(new, concerned, settings), accounts)
    folder = run_folder(output, "alerts", run_epoch)
    write_lines(alert_lines(records, moment(run_ts), settings), folder)

    store.write(novelty.merge(baseline, decisions, run_epoch, settings.ttl), version + 1)
    store.publish(version + 1, run_epoch)
    counters = {**scanned.get, **all_actions.get, **judged_actions.get}
    counters["unknown_principal_actions"] = (
        counters["principal_actions"] - counters["role_actions"]
    )
    return TickResult(version + 1, folder, counters)
