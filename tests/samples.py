"""Small hand-written inputs in the original shapes."""

import json
from datetime import datetime, timezone

from pyspark.sql import types as T

RUN = datetime(2024, 1, 2, 12, 0, 0, 123000, tzinfo=timezone.utc)

FIRST = {
    "eventVersion": "1.08",
    "userIdentity": {
        "type": "AssumedRole",
        "principalId": "AROAX:s",
        "sessionContext": {
            "attributes": {"mfaAuthenticated": "false"},
            "sessionIssuer": {"type": "Role", "principalId": "AROAX", "arn": "arn:aws:iam::1:role/r"},
        },
    },
    "eventTime": "2024-01-02T11:00:00Z",
    "eventSource": "s3.amazonaws.com",
    "eventName": "GetObject",
    "sourceIPAddress": "10.0.0.1",
    "requestID": "req-1",
    "eventID": "ev-1",
    "requestParameters": {"bucketName": "b", "n": {"x": 1}},
    "resources": [{"arn": "a", "accountId": "1", "type": "t"}],
    "readOnly": True,
}
SECOND = {
    "eventVersion": "1.08",
    "userIdentity": {"type": "Root", "principalId": "1"},
    "eventTime": "2024-01-02T10:59:59Z",
    "eventSource": "iam.amazonaws.com",
    "eventName": "ListRoles",
}


def put_audit_file(base, records, account="1", region="us-east-1", day="2024/01/02", name="x.json"):
    folder = base / account / "CloudTrail" / region / day
    folder.mkdir(parents=True, exist_ok=True)
    text = records if isinstance(records, str) else json.dumps({"Records": records})
    (folder / name).write_text(text)


CALL = T.StructType(
    [
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_source", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("principal_id", T.StringType()),
        T.StructField("identity_type", T.StringType()),
    ]
)


def calls(spark, rows):
    """Rows of (epoch seconds, role, action name)."""
    return spark.createDataFrame(
        [
            (datetime.fromtimestamp(at, timezone.utc), "svc", name, role, "AssumedRole")
            for at, role, name in rows
        ],
        CALL,
    )


ROLE = (
    "role_id string, role_name string, account string, role_arn string, "
    "create_epoch bigint, principal_json string, role_doc string"
)


def role(role_id, principal='{"Service":"ec2.amazonaws.com"}', created=0, path="", account="1"):
    name = f"name-{role_id}"
    arn = f"arn:aws:iam::{account}:role/{path}{name}"
    return (role_id, name, account, arn, created, principal, f"doc of {role_id}")


def roles(spark, *rows):
    return spark.createDataFrame(list(rows), ROLE)


def accounts(spark):
    return spark.createDataFrame(
        [("1", "One", "one@example.com", "ACTIVE", "retail")],
        "account string, account_name string, account_owner string, status string, business string",
    )


def plan_of(frame):
    return frame._jdf.queryExecution().toString()
