"""Declared schemas.  Nothing is inferred; audit leaves are all texts."""

from __future__ import annotations

from pyspark.sql import types as T


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


ISSUER = T.StructType(_texts("type", "principalId", "arn", "accountId", "userName"))
SESSION_CONTEXT = T.StructType(
    [
        T.StructField(
            "attributes", T.StructType(_texts("mfaAuthenticated", "creationDate"))
        ),
        T.StructField("sessionIssuer", ISSUER),
    ]
)
USER_IDENTITY = T.StructType(
    _texts(
        "type", "principalId", "arn", "accountId", "invokedBy", "accessKeyId", "userName"
    )
    + [T.StructField("sessionContext", SESSION_CONTEXT)]
)
RESOURCES = T.ArrayType(T.StructType(_texts("arn", "accountId", "type")))

# Columns of the audit table.
AUDIT_RECORD = T.StructType(
    _texts("eventVersion")
    + [T.StructField("userIdentity", USER_IDENTITY)]
    + _texts(
        "eventTime",
        "eventSource",
        "eventName",
        "awsRegion",
        "sourceIpAddress",
        "userAgent",
        "errorCode",
        "errorMessage",
        "requestParameters",
        "responseElements",
        "additionalEventData",
        "requestId",
        "eventId",
    )
    + [T.StructField("resources", RESOURCES)]
    + _texts(
        "eventType",
        "apiVersion",
        "readOnly",
        "recipientAccountId",
        "serviceEventDetails",
        "sharedEventID",
        "vpcEndpointId",
    )
)

# The JSON reader matches keys by exact case; these three differ in the files.
JSON_KEYS = {
    "sourceIpAddress": "sourceIPAddress",
    "requestId": "requestID",
    "eventId": "eventID",
}
JSON_RECORD = T.StructType(
    [
        T.StructField(JSON_KEYS.get(field.name, field.name), field.dataType)
        for field in AUDIT_RECORD.fields
    ]
)
CORRUPT = "_corrupt_record"
AUDIT_FILE = T.StructType(
    [T.StructField("Records", T.ArrayType(JSON_RECORD))] + _texts(CORRUPT)
)

PARTITIONS = ("year", "month", "day", "hour")
UNREADABLE = ("reason", "origin", "content")
AUDIT_TABLE = T.StructType(
    AUDIT_RECORD.fields
    + _texts("account", "region")
    + [T.StructField("event_ts", T.TimestampType())]
    + _texts(*PARTITIONS)
)

ACCOUNT_EXPORT = T.StructType(_texts("Id", "Name", "Email", "Status"))
ROLE_EXPORT = T.StructType(
    _texts("account", "Arn", "RoleName", "RoleId")
    + [T.StructField("CreateDate", T.TimestampType())]
    + _texts("AssumeRolePolicyDocument")
)

WORK_ITEM = T.StructType(
    _texts("account")
    + [T.StructField("current_date", T.ArrayType(T.StringType()))]
    + _texts("ct_bucket", "business", "owner", "name")
)

BASELINE = T.StructType(
    _texts("role_id", "action") + [T.StructField("ttl", T.LongType())]
)
BASELINE_KEY = ("role_id", "action")
OCCURRENCE = T.StructType(
    _texts("role_id", "action") + [T.StructField("tick", T.LongType())]
)
ALERT_FIELDS = (
    "role_name",
    "account",
    "role_arn",
    "principalId",
    "role_actions",
    "alert_name",
    "alert_note",
    "association_type",
    "associated_with",
    "association_message",
    "severity",
    "business",
    "account_owner",
    "account_name",
)
