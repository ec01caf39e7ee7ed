"""Trust classes, grouping, suppression, severity and payloads."""

import json
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from rolehabit.functions.moments import moment
from rolehabit.functions.trust import classify
from rolehabit.operators import alerts
from rolehabit.plans.replay import replay_alerts
from rolehabit.settings import DAY, Settings
from rolehabit.sinks.emission import alert_lines, for_topic
from tests.samples import accounts, calls, role, roles

IDP = Settings(idp_token="IDP")
SERVICE = (
    "AWS services can be associated with this role. The following service(s) can be "
    "associated with this particular role: "
)

TRUTH = [
    ('{"Service":"ec2"}', "Service", "High", "ec2"),
    ('{"Service":["a","b"]}', "Service", "High", '["a","b"]'),
    ('{"Service":"ec2","AWS":"x"}', "Service", "High", "ec2"),
    ('{"AWS":"x","Federated":"y"}', "Federated", "High", "y"),
    ('{"Federated":"arn:x/IDP"}', "Federated", "Informational", "arn:x/IDP"),
    ('{"Federated":"other"}', "Federated", "High", "other"),
    ('{"Federated":["IDP","z"]}', "Federated", "Informational", '["IDP","z"]'),
    ('{"Federated":["arn:x/IDP"]}', "Federated", "High", '["arn:x/IDP"]'),
    ('{"AWS":"arn:1"}', "AWS", "Medium", "arn:1"),
    ('{"AWS":["a","b"]}', "AWS", "Medium", '["a","b"]'),
    ('"*"', "?", "Informational", "?"),
    ('{"CanonicalUser":"c"}', "?", "Informational", "?"),
]


def test_trust_classes(spark):
    frame = roles(spark, *[role(str(n), case[0]) for n, case in enumerate(TRUTH)])
    rows = {
        r.role_id: r
        for r in classify(frame, IDP).withColumn(
            "associated_with", F.col("associated_with").cast("string")
        ).collect()
    }
    for n, (_, kind, severity, associated) in enumerate(TRUTH):
        row = rows[str(n)]
        assert (row.association_type, row.base_severity, row.associated_with) == (
            kind,
            severity,
            associated,
        )
        if kind == "Service":
            assert row.association_message == SERVICE + associated
        if kind == "?":
            assert row.association_message == f"doc of {n}"


def new_rows(spark, counts):
    rows = [(r, f"svc:a{n}", 0) for r, count in counts.items() for n in range(count)]
    return spark.createDataFrame(rows, "role_id string, action string, tick bigint")


def test_downgrade_counts_only_reported_actions(spark):
    counts = {"zero": 0, "one": 1, "four": 4, "five": 5, "ignored": 5}
    new = new_rows(spark, counts).where("role_id <> 'ignored' OR action <> 'x'")
    extra = spark.createDataFrame(
        [("six", f"svc:b{n}", 0) for n in range(4)] + [("six", "svc:skip", 0)], new.schema
    )
    frame = roles(spark, *[role(name) for name in [*counts, "six"]])
    settings = Settings(ignored_actions=("svc:skip",))
    rows = alerts.judged(new.unionByName(extra), frame, settings).collect()
    assert {r.role_id: (r.n_new, r.severity) for r in rows} == {
        "one": (1, "Informational"),
        "four": (4, "Informational"),
        "five": (5, "High"),
        "ignored": (5, "High"),
        "six": (4, "Informational"),
    }


def test_ignored_services(spark):
    new = spark.createDataFrame(
        [("r", "a.com:x", 0), ("r", "b.com:x", 0)], "role_id string, action string, tick bigint"
    )
    kept = alerts.reportable(new, Settings(ignored_services=("a.com",))).collect()
    assert [r.action for r in kept] == ["b.com:x"]


def test_suppression(spark):
    now = 100 * DAY
    edge = now - 15 * DAY
    cases = [
        (role("edge", created=edge), ""),
        (role("young", created=edge + 1), "too_new"),
        (role("old", created=edge - 1), ""),
        (role("linked", path="aws-service-role/x/"), "service_linked"),
        (role("lookalike", path="my-aws-service-role/"), ""),
        (role("both", created=now, path="aws-service-role/"), "too_new,service_linked"),
        (role("ignored"), "ignored_role"),
        (role("undated", created=None), ""),
    ]
    new = new_rows(spark, {case[0][0]: 1 for case in cases}).withColumn(
        "tick", F.lit(now).cast("bigint")
    )
    settings = Settings(ignored_roles=("name-ignored",))
    frame = roles(spark, *[case[0] for case in cases])
    rows = alerts.judged(new, frame, settings).collect()
    assert {r.role_id: r.skip_reason for r in rows} == {c[0][0]: c[1] for c in cases}
    kept = alerts.sent(alerts.judged(new, frame, settings)).collect()
    assert {r.role_id for r in kept} == {"edge", "old", "lookalike", "undated"}


@pytest.mark.parametrize("as_list", [False, True])
def test_golden_alert(spark, as_list):
    settings = replace(Settings(), owner_as_list=as_list)
    frame = roles(spark, role("R1", '{"AWS":["a","b"]}'))
    seen = calls(spark, [(10, "R1", "Put"), (20, "R1", "Get")])
    found = replay_alerts(seen, frame, accounts(spark), 3600, replace(settings, role_grace=0))
    at = datetime(2024, 1, 1, 0, 0, 0, 250000, tzinfo=timezone.utc)
    lines = alert_lines(found, moment(at), settings)
    (line,) = [r.value for r in lines.collect()]
    assert line.startswith(
        '{"index":"main","sourcetype":"lambda:cloudtrailanomaly","event":"{\\"role_name\\":'
    )
    envelope = json.loads(line)
    assert list(envelope) == ["index", "sourcetype", "event", "time"]
    assert envelope["time"] == 1704067200.25
    alert = json.loads(envelope["event"])
    assert list(alert.items()) == [
        ("role_name", "name-R1"),
        ("account", "1"),
        ("role_arn", "arn:aws:iam::1:role/name-R1"),
        ("principalId", "R1"),
        ("role_actions", ["svc:Get", "svc:Put"]),
        ("alert_name", "CloudTrailAnomaly"),
        (
            "alert_note",
            "Activity has been detected that is not within the past 90 days baseline "
            "activity for this role and account.",
        ),
        ("association_type", "AWS"),
        ("associated_with", ["a", "b"]),
        (
            "association_message",
            "This is a role from another account. Someone or thing requested temporary "
            "access keys to this account and made API calls.",
        ),
        ("severity", "Informational"),
        ("business", "retail"),
        ("account_owner", ["one@example.com"] if as_list else "one@example.com"),
        ("account_name", "One"),
    ]
    (wrapped,) = [r.value for r in for_topic(lines).collect()]
    assert json.loads(wrapped) == {"default": line}
