"""Alerts: grouping, classes, suppression, records and payloads."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from rolehabit.functions.payloads import topic_message
from rolehabit.functions.trust import classify
from rolehabit.operators import activity, alerts
from rolehabit.plans.replay import replay, replay_alerts, warm_up
from rolehabit.plans.tick import roles_in_scope, run_tick
from rolehabit.registry.base import (
    ALERTS,
    DAILY,
    IDP,
    WEEKLY,
    classed,
    fx_accounts,
    fx_calls,
    fx_roles,
    judged,
    over_views,
    registered,
    table,
)
from rolehabit.session import shared_folder
from rolehabit.settings import DAY, ROLE_BRANCH, ROOT_BRANCH, USER_BRANCH
from rolehabit.sinks.emission import alert_lines
from rolehabit.sources.baseline import BaselineStore
from rolehabit.sources.inventory import selected_accounts

SETTINGS = replace(WEEKLY, idp_token=IDP)


def daily_news(spark, sf_dir):
    return replay(fx_calls(spark, sf_dir), fx_roles(spark, sf_dir), DAY, SETTINGS)


def daily_alerts(spark, sf_dir, settings=SETTINGS):
    return replay_alerts(
        fx_calls(spark, sf_dir), fx_roles(spark, sf_dir), fx_accounts(spark, sf_dir), DAY, settings
    )


def joined(actions):
    return F.array_join(actions, ",")


@registered(
    over_views(
        """
SELECT role_id, tick, string_agg(action, ',' ORDER BY action) AS role_actions, count(*) AS n_new
FROM news GROUP BY role_id, tick""",
        DAILY,
    )
)
def role_new_action_sets(spark, sf_dir):
    """New actions per role and run."""
    groups = alerts.group_by_role(daily_news(spark, sf_dir))
    return groups.withColumn("role_actions", joined("role_actions"))


@registered(
    over_views(
        """
SELECT role_id, association_type, associated_with, association_message, base_severity
FROM classed""",
        classed("fx_roles"),
    )
)
def trust_classification(spark, sf_dir):
    """The class of every role."""
    return classify(fx_roles(spark, sf_dir), SETTINGS).select(
        "role_id",
        "association_type",
        F.col("associated_with").cast("string").alias("associated_with"),
        "association_message",
        "base_severity",
    )


@registered(
    over_views(
        "SELECT role_id, tick, n_new, base_severity, severity FROM judged", DAILY, judged()
    )
)
def severity_downgrade(spark, sf_dir):
    """Fewer than five new actions make an alert Informational."""
    verdicts = alerts.judged(daily_news(spark, sf_dir), fx_roles(spark, sf_dir), SETTINGS)
    return verdicts.select("role_id", "tick", "n_new", "base_severity", "severity")


IGNORED_ROLES = ("Customer#000000003", "Customer#000000040", "Customer#000000101")


@registered(
    over_views(
        """
SELECT role_id, tick, too_new, service_linked, ignored_role, skip_reason,
       skip_reason = '' AS sent
FROM judged""",
        DAILY,
        judged(ignored_role=f"role_name IN {IGNORED_ROLES}"),
    )
)
def suppression_reasons(spark, sf_dir):
    """Why an alert is held back, if it is."""
    settings = replace(SETTINGS, ignored_roles=IGNORED_ROLES)
    verdicts = alerts.judged(daily_news(spark, sf_dir), fx_roles(spark, sf_dir), settings)
    return verdicts.select(
        "role_id",
        "tick",
        *[flag.alias(name) for name, flag in alerts.suppression_flags(settings).items()],
        "skip_reason",
        (F.col("skip_reason") == "").alias("sent"),
    )


@registered(
    over_views(
        """
SELECT role_id, tick, string_agg(action, ',' ORDER BY action) AS role_actions, count(*) AS n_new
FROM news WHERE action NOT IN ('svc1.example.com:click', 'svc2.example.com:view')
GROUP BY role_id, tick""",
        DAILY,
    )
)
def ignored_actions(spark, sf_dir):
    """F8, Q10: ignored actions are not listed and do not count."""
    settings = replace(
        SETTINGS, ignored_actions=("svc1.example.com:click", "svc2.example.com:view")
    )
    groups = alerts.group_by_role(alerts.reportable(daily_news(spark, sf_dir), settings))
    return groups.withColumn("role_actions", joined("role_actions"))


@registered(
    over_views(
        """
SELECT role_id, tick, string_agg(action, ',' ORDER BY action) AS role_actions, count(*) AS n_new
FROM news WHERE string_split(action, ':')[1] NOT IN ('svc3.example.com')
GROUP BY role_id, tick""",
        DAILY,
    )
)
def ignored_services(spark, sf_dir):
    """the same for whole services."""
    settings = replace(SETTINGS, ignored_services=("svc3.example.com",))
    groups = alerts.group_by_role(alerts.reportable(daily_news(spark, sf_dir), settings))
    return groups.withColumn("role_actions", joined("role_actions"))


ALERT_COLUMNS = """tick, role_name, account, role_arn, "principalId", role_actions, alert_name,
       alert_note, association_type, associated_with, association_message, severity,
       business, account_owner, account_name"""


@registered(over_views(f"SELECT {ALERT_COLUMNS} FROM alerts", DAILY, judged(), ALERTS))
def alerts_full(spark, sf_dir):
    """Every alert of the history."""
    return daily_alerts(spark, sf_dir).withColumns(
        {
            "role_actions": joined("role_actions"),
            "associated_with": F.col("associated_with").cast("string"),
        }
    )


BODY = """
bodies AS (
  SELECT tick, severity, CAST(json_object(
    'role_name', role_name, 'account', account, 'role_arn', role_arn,
    'principalId', "principalId", 'role_actions', action_list, 'alert_name', alert_name,
    'alert_note', alert_note, 'association_type', association_type,
    'associated_with', coalesce(json_extract(principal_json, '$.Service'),
                                json_extract(principal_json, '$.Federated'),
                                json_extract(principal_json, '$.AWS'), CAST('"?"' AS JSON)),
    'association_message', association_message, 'severity', severity,
    'business', business, 'account_owner', {owner}, 'account_name', account_name
    ) AS VARCHAR) AS event
  FROM alerts),
lines AS (
  SELECT '{{"index":"main","sourcetype":"lambda:cloudtrailanomaly","event":'
         || CAST(to_json(event) AS VARCHAR) || ',"time":' || tick || '.000000}}' AS value
  FROM bodies)"""


def lines(spark, sf_dir, settings=SETTINGS):
    tick = F.timestamp_seconds("tick")
    return alert_lines(daily_alerts(spark, sf_dir, settings), tick, settings)


@registered(
    over_views(
        "SELECT value FROM lines", DAILY, judged(), ALERTS, BODY.format(owner="account_owner")
    )
)
def alert_envelope(spark, sf_dir):
    """P10, C11, K3: the JSON text of every alert."""
    return lines(spark, sf_dir)


@registered(
    over_views(
        "SELECT value FROM lines", DAILY, judged(), ALERTS, BODY.format(owner="[account_owner]")
    )
)
def alert_envelope_owner_list(spark, sf_dir):
    """Q3: the owner as a one-element list, as it used to be sent."""
    return lines(spark, sf_dir, replace(SETTINGS, owner_as_list=True))


@registered(
    over_views(
        "SELECT '{\"default\":' || CAST(to_json(value) AS VARCHAR) || '}' AS value FROM lines",
        DAILY,
        judged(),
        ALERTS,
        BODY.format(owner="account_owner"),
    )
)
def alert_topic_messages(spark, sf_dir):
    """K4: the same, wrapped for a topic."""
    return lines(spark, sf_dir).select(topic_message(F.col("value")).alias("value"))


@registered(
    over_views(
        """
SELECT 'AssumedRole' AS branch, "principalId" AS principal_id, tick, severity,
       CAST(NULL AS BIGINT) AS calls
FROM alerts
UNION ALL
SELECT identity_type, principal_id,
       CAST((epoch_us(event_ts) // 86400000000 + 1) * 86400 AS BIGINT), NULL, count(*)
FROM fx_audit WHERE identity_type IN ('Root', 'IAMUser') GROUP BY ALL""",
        DAILY,
        judged(),
        ALERTS,
    )
)
def alerts_union(spark, sf_dir):
    """Role alerts together with the counts of the branches that only count."""
    reported = daily_alerts(spark, sf_dir).select(
        F.lit(ROLE_BRANCH).alias("branch"),
        F.col("principalId").alias("principal_id"),
        "tick",
        "severity",
    )
    routed = activity.routed(activity.on_ticks(fx_calls(spark, sf_dir), DAY))
    counted = [
        routed.where(F.col("branch") == name)
        .groupBy("branch", "principal_id", "tick")
        .agg(F.count("*").alias("calls"))
        for name in (ROOT_BRANCH, USER_BRANCH)
    ]
    return alerts.all_branches(reported, *counted)


@registered(
    over_views(
        """
SELECT 'roles' AS counter, count(*) AS value FROM fx_roles
UNION ALL SELECT 'role_actions', count(*) FROM occ
UNION ALL SELECT 'unknown_principals', count(*) FROM (
  SELECT DISTINCT principal_id, event_source, event_name, event_ts // 1 FROM (
    SELECT principal_id, event_source, event_name, epoch_us(event_ts) // 86400000000 AS event_ts
    FROM fx_audit WHERE identity_type = 'AssumedRole'
      AND principal_id NOT IN (SELECT role_id FROM big_roles)))
UNION ALL SELECT 'new_actions', count(*) FROM news
UNION ALL SELECT 'alerts', count(*) FROM alerts""",
        DAILY,
        judged(),
        ALERTS,
        """
big_roles AS (SELECT CAST(c_custkey AS VARCHAR) AS role_id FROM customer WHERE c_acctbal > 0)""",
    )
)
def run_counters(spark, sf_dir):
    """How much a replay looked at; principals in no inventory are counted
    against an inventory of the customers in credit."""
    roles = fx_roles(spark, sf_dir)
    actions = activity.role_actions(activity.on_ticks(fx_calls(spark, sf_dir), DAY))
    solvent = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    partial = solvent.select(F.col("c_custkey").cast("string").alias("role_id"))
    counted = {
        "roles": roles,
        "role_actions": activity.of_known_roles(actions, roles),
        "unknown_principals": activity.unknown_principals(actions, partial),
        "new_actions": daily_news(spark, sf_dir),
        "alerts": daily_alerts(spark, sf_dir),
    }
    return alerts.all_branches(
        *[
            rows.agg(F.count("*").alias("value")).select(F.lit(name).alias("counter"), "value")
            for name, rows in counted.items()
        ]
    )


ALERT_EVENT = (
    "role_name string, account string, role_arn string, principalId string, "
    "role_actions array<string>, alert_name string, alert_note string, "
    "association_type string, associated_with string, association_message string, "
    "severity string, business string, account_owner string, account_name string"
)


def parsed_alerts(written):
    """Alert fields out of written lines."""
    event = F.get_json_object("value", "$.event")
    seconds = F.get_json_object("value", "$.time").cast("decimal(17,6)")
    return written.select(
        seconds.cast("bigint").alias("tick"), F.from_json(event, ALERT_EVENT).alias("alert")
    ).select("tick", "alert.*")


@registered(
    over_views(
        f"SELECT {ALERT_COLUMNS} FROM alerts",
        DAILY,
        """
one_run AS (
  SELECT o.role_id, o.action, o.tick FROM occ o
  LEFT JOIN (SELECT role_id, action, max(tick) AS last FROM occ WHERE tick <= 1705276800
             GROUP BY ALL) b ON o.role_id = b.role_id AND o.action = b.action
  WHERE o.tick = 1705363200 AND (b.last IS NULL OR o.tick - b.last > 604800))""",
        judged("one_run"),
        ALERTS,
    )
)
def tick_lifecycle(spark, sf_dir):
    """Warm-up to a snapshot, one run against it, and the alerts
    read back from the lines it wrote."""
    calls, roles = fx_calls(spark, sf_dir), fx_roles(spark, sf_dir)
    accounts = fx_accounts(spark, sf_dir)
    scope = roles_in_scope(roles, selected_accounts(accounts, SETTINGS))
    root = f"{shared_folder(spark)}/tick-{uuid.uuid4().hex}"
    store = BaselineStore(spark, f"{root}/baseline")
    warm_up(calls, scope, store, datetime(2024, 1, 15), DAY, SETTINGS)
    run_ts = datetime(2024, 1, 16)
    result = run_tick(calls, roles, accounts, store, f"{root}/out", run_ts, SETTINGS)
    written = spark.read.schema("value string").text(result.alerts_folder)
    return parsed_alerts(written).withColumn("role_actions", joined("role_actions"))
