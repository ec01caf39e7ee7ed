"""From new actions to alerts, one per role and tick."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolehabit.functions.texts import has_segment, is_listed, service_of
from rolehabit.functions.trust import classify
from rolehabit.schemas import ALERT_FIELDS
from rolehabit.settings import ALERT_NAME, ALERT_NOTE, SERVICE_LINKED_SEGMENT, Settings


def reportable(new_actions: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Leave out ignored actions and services.  They have been learned already:
    this runs after the baseline's write set is fixed."""
    action = F.col("action")
    return new_actions.where(~is_listed(action, settings.ignored_actions)).where(
        ~is_listed(service_of(action), settings.ignored_services)
    )


def group_by_role(new_actions: DataFrame) -> DataFrame:
    """New actions of a role at a tick as one sorted list, with their number.

    The list is the alert's own content, and its input is distinct, so a group is
    as large as the record it becomes and no larger.
    """
    return new_actions.groupBy("role_id", "tick").agg(
        F.array_sort(F.collect_list("action")).alias("role_actions"),
        F.count("*").alias("n_new"),
    )


def suppression_flags(settings: Settings = Settings()) -> dict[str, Column]:
    """Why a role's alert is held back; never NULL."""
    too_new = F.col("create_epoch") > F.col("tick") - settings.role_grace
    linked = has_segment(F.col("role_arn"), SERVICE_LINKED_SEGMENT)
    return {
        "too_new": F.coalesce(too_new, F.lit(False)),
        "service_linked": F.coalesce(linked, F.lit(False)),
        "ignored_role": is_listed(F.col("role_name"), settings.ignored_roles),
    }


def skip_reason(settings: Settings = Settings()) -> Column:
    """Names of the flags that apply, comma-separated; empty when none does."""
    named = [F.when(flag, F.lit(name)) for name, flag in suppression_flags(settings).items()]
    return F.concat_ws(",", *named)


def severity(settings: Settings = Settings()) -> Column:
    return F.when(
        F.col("n_new") < settings.downgrade_below, F.lit("Informational")
    ).otherwise(F.col("base_severity"))


def judged(
    new_actions: DataFrame, roles: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Grouped actions with role details, class, severity and skip reason; held
    back ones are still there.

    Policies are classified before the join, once per role: over a history a role
    has many groups.  For a single tick pass only ``roles_with_news``.
    """
    groups = group_by_role(reportable(new_actions, settings))
    return groups.join(classify(roles, settings), "role_id").withColumns(
        {"severity": severity(settings), "skip_reason": skip_reason(settings)}
    )


def roles_with_news(roles: DataFrame, new_actions: DataFrame) -> DataFrame:
    """The few roles a tick has something new for."""
    return roles.join(new_actions.select("role_id"), "role_id", "left_semi")


def sent(judged_groups: DataFrame) -> DataFrame:
    return judged_groups.where(F.col("skip_reason") == "")


def alert_records(judged_groups: DataFrame, accounts: DataFrame) -> DataFrame:
    """The fourteen alert fields plus the tick."""
    named = sent(judged_groups).join(
        accounts.select("account", "account_name", "account_owner", "business"), "account"
    )
    return named.withColumns(
        {
            "principalId": F.col("role_id"),
            "alert_name": F.lit(ALERT_NAME),
            "alert_note": F.lit(ALERT_NOTE),
        }
    ).select("tick", *ALERT_FIELDS)


def all_branches(*alerts: DataFrame) -> DataFrame:
    """Alerts of all identity branches together."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alerts)
