"""Inputs: accounts, roles, work items, audit files and the quarantine."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from rolehabit.functions.moments import moment
from rolehabit.operators import activity
from rolehabit.registry.base import (
    VIEWS,
    calls_from,
    fx_accounts,
    fx_roles,
    over_views,
    registered,
    table,
)
from rolehabit.schemas import PARTITIONS
from rolehabit.session import shared_folder
from rolehabit.settings import REGIONS, Settings
from rolehabit.sinks.emission import error_lines
from rolehabit.sources import audit, inventory
from rolehabit.sources.audit import read_audit_table

RUN = datetime(2024, 1, 15, 12)


def new_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@registered(
    over_views(
        """
SELECT r.role_id, r.role_name, a.account, a.account_name, a.account_owner, a.business
FROM fx_roles r JOIN fx_accounts a ON r.account = a.account
WHERE a.status = 'ACTIVE' AND a.account NOT IN ('3', '7')"""
    )
)
def active_accounts(spark, sf_dir):
    """Roles of active accounts that are not skipped, with owner and business."""
    settings = Settings(skipped_accounts=("3", "7"))
    accounts = inventory.selected_accounts(fx_accounts(spark, sf_dir), settings)
    roles = fx_roles(spark, sf_dir).select("role_id", "role_name", "account")
    return roles.join(accounts.drop("status"), "account")


@registered(
    over_views(
        """
SELECT r.role_id, a.account, a.account_name, 'nation_1' AS business
FROM fx_roles r JOIN fx_accounts a ON r.account = a.account
WHERE a.status = 'ACTIVE' AND contains(lower(a.account_name), 'nation_1')"""
    )
)
def business_filter(spark, sf_dir):
    """roles of accounts whose lower-cased name contains the business token."""
    settings = Settings(business_token="nation_1")
    accounts = inventory.selected_accounts(fx_accounts(spark, sf_dir), settings)
    roles = fx_roles(spark, sf_dir).select("role_id", "account")
    return roles.join(accounts.select("account", "account_name", "business"), "account")


@registered(
    """
SELECT CAST(c_custkey AS VARCHAR) AS account, '2024' AS "year", '01' AS "month", '15' AS "day",
       'audit-logs' AS ct_bucket, 'retail' AS business,
       c_mktsegment AS account_owner, c_name AS account_name
FROM customer"""
)
def work_item_messages(spark, sf_dir):
    """One message per account, written and parsed again."""
    accounts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("account"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("account_owner"),
    )
    items = inventory.work_items(
        inventory.with_constants(accounts, "retail", "audit-logs"), RUN
    )
    return inventory.parse_work_items(items)


@registered(
    """
SELECT o_custkey, o_orderkey, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
  FROM orders) WHERE place = 1"""
)
def dedupe_inventory(spark, sf_dir):
    """A4: the last record per key wins."""
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )
    newest = inventory.latest(rows, "o_custkey", F.struct("o_orderdate", "o_orderkey"))
    return newest.drop("o_orderdate")


@registered(
    """
SELECT CAST(c_custkey AS VARCHAR) AS account, c_name AS account_name,
       concat(lower(c_name), '@example.com') AS account_owner, 'ACTIVE' AS status
FROM customer WHERE c_acctbal > 0"""
)
def account_export(spark, sf_dir):
    """S3, F1: an account export written as JSON and read back."""
    folder = new_folder(spark, "accounts")
    status = F.when(F.col("c_acctbal") > 0, "ACTIVE").otherwise("SUSPENDED")
    table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("Id"),
        F.col("c_name").alias("Name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
        status.alias("Status"),
    ).write.json(folder)
    return inventory.read_accounts(spark, folder)


def write_role_export(spark, sf_dir) -> str:
    """Roles in the form of an export; roles of customers in debt lack a principal."""
    folder = new_folder(spark, "roles")
    principal = F.when(
        F.col("c_acctbal") > 0, F.concat(F.lit('"Principal":'), "principal_json", F.lit(","))
    ).otherwise("")
    policy = F.concat(
        F.lit('{"Version":"2012-10-17","Statement":[{"Effect":"Allow",'),
        principal,
        F.lit('"Action":"sts:AssumeRole"}]}'),
    )
    debts = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("role_id"), "c_acctbal"
    )
    fx_roles(spark, sf_dir).join(debts, "role_id").select(
        "account",
        F.col("role_arn").alias("Arn"),
        F.col("role_name").alias("RoleName"),
        F.col("role_id").alias("RoleId"),
        F.timestamp_seconds("create_epoch").alias("CreateDate"),
        F.parse_json(policy).alias("AssumeRolePolicyDocument"),
    ).write.json(folder)
    return folder


@registered(
    over_views(
        """
SELECT role_id, role_name, account, role_arn, create_epoch, principal_json
FROM fx_roles JOIN customer ON role_id = CAST(c_custkey AS VARCHAR) WHERE c_acctbal > 0"""
    )
)
def role_export(spark, sf_dir):
    """A role export written as JSON and read back."""
    roles = inventory.read_roles(spark, write_role_export(spark, sf_dir))
    return inventory.usable_roles(roles).drop("role_doc")


@registered(
    over_views(
        """
SELECT 'no principal in first statement' AS error_note, role_arn AS note,
       'lambda:cloudtrailanomaly:error' AS sourcetype, 1705320000 AS "time"
FROM fx_roles JOIN customer ON role_id = CAST(c_custkey AS VARCHAR) WHERE c_acctbal <= 0"""
    )
)
def quarantined_roles(spark, sf_dir):
    """K5: roles that cannot be classified, as error events."""
    roles = inventory.read_roles(spark, write_role_export(spark, sf_dir))
    lines = error_lines(inventory.roles_without_principal(roles), moment(RUN))
    event = F.get_json_object("value", "$.event")
    return lines.select(
        F.get_json_object(event, "$.error_note").alias("error_note"),
        F.get_json_object(event, "$.note").alias("note"),
        F.get_json_object("value", "$.sourcetype").alias("sourcetype"),
        F.get_json_object("value", "$.time").cast("double").cast("int").alias("time"),
    )


#: Records of one account and day in a file, about: a busy day has several files.
RECORDS_PER_FILE = 10_000
HOME_ACCOUNTS = 5


def write_audit_files(spark, sf_dir) -> str:
    """The events as nested audit files, one JSON document each."""
    folder = new_folder(spark, "audit")
    calls = calls_from(table(spark, sf_dir, "events"), "props")
    account = F.col("account").cast("int") % HOME_ACCOUNTS
    homes = fx_roles(spark, sf_dir).select(
        F.col("role_id").alias("principal_id"), account.cast("string").alias("account")
    )
    regions = F.array(*[F.lit(region) for region in REGIONS])
    place = F.element_at(regions, F.col("account").cast("int") + 1)
    rows = calls.join(homes, "principal_id").withColumn("region", place)
    assumed = F.col("identity_type") == "AssumedRole"
    issuer = F.struct(F.lit("Role").alias("type"), F.col("principal_id").alias("principalId"))
    identity = F.struct(
        F.col("identity_type").alias("type"),
        F.concat(F.col("principal_id"), F.lit(":session")).alias("principalId"),
        F.when(assumed, F.struct(issuer.alias("sessionIssuer"))).alias("sessionContext"),
    )
    resource = F.struct(F.lit("arn:x").alias("arn"), F.col("account").alias("accountId"))
    record = F.struct(
        F.lit("1.08").alias("eventVersion"),
        identity.alias("userIdentity"),
        F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        F.col("event_source").alias("eventSource"),
        F.col("event_name").alias("eventName"),
        F.col("region").alias("awsRegion"),
        F.parse_json("props").alias("requestParameters"),
        F.col("event_id").cast("string").alias("eventID"),
        F.array(resource).alias("resources"),
        (F.col("event_name") == "view").alias("readOnly"),
    )
    where = ["account", "region", "year", "month", "day"]
    dated = rows.select(
        "account",
        "region",
        *[F.date_format("event_ts", f).alias(n) for n, f in zip(where[2:], ("yyyy", "MM", "dd"))],
        F.to_json(record).alias("record"),
    ).withColumn("folder", F.xxhash64(*where))  # never null, so that the join keeps every row
    sizes = dated.groupBy("folder").agg(F.ceil(F.count("*") / RECORDS_PER_FILE).alias("files"))
    part = F.pmod(F.xxhash64("record"), "files").alias("part")
    documents = dated.join(sizes, "folder").groupBy(*where, part).agg(
        F.concat(
            F.lit('{"Records":['), F.array_join(F.collect_list("record"), ","), F.lit("]}")
        ).alias("value")
    )
    (
        documents.drop("part")
        .write.option("maxRecordsPerFile", 1)
        .partitionBy(*where)
        .text(folder)
    )
    return folder


_INGESTED: dict[tuple[str, str], str] = {}


def ingested_table(spark, sf_dir) -> str:
    """The audit table of the events, made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INGESTED:
        files = write_audit_files(spark, sf_dir)
        folder = new_folder(spark, "table")
        flat = audit.flatten(audit.read_files_below(spark, files))
        audit.write_audit_table(flat, folder, partitions=PARTITIONS[:3])
        _INGESTED[key] = folder
    return _INGESTED[key]


PLACED = f"""
places AS (SELECT * FROM (VALUES {', '.join(f"({n}, '{r}')" for n, r in enumerate(REGIONS))})
           AS p(place, region)),
placed AS (
  SELECT f.*, CAST(p.place AS VARCHAR) AS account, p.region, e.props
  FROM fx_audit f JOIN fx_roles r ON f.principal_id = r.role_id
  JOIN places p ON CAST(r.account AS INT) % 5 = p.place
  JOIN events e ON e.event_id = f.event_id)"""


@registered(
    f"""
WITH {VIEWS}, {PLACED}
SELECT CAST(event_id AS VARCHAR) AS event_id, account, region,
       CAST(epoch_us(event_ts) // 1000000 AS BIGINT) AS epoch,
       strftime(event_ts, '%Y') AS "year", strftime(event_ts, '%m') AS "month",
       strftime(event_ts, '%d') AS "day", strftime(event_ts, '%H') AS "hour",
       event_source, event_name, identity_type,
       CASE WHEN identity_type = 'AssumedRole' THEN principal_id END AS principal_id,
       json_extract_string(props, '$.k') AS k,
       CASE WHEN event_name = 'view' THEN 'true' ELSE 'false' END AS read_only,
       account AS resource_account
FROM placed"""
)
def json_ingest_roundtrip(spark, sf_dir):
    """Events written as nested audit files, flattened, and read back."""
    records = read_audit_table(spark, ingested_table(spark, sf_dir))
    return records.select(
        F.col("eventId").alias("event_id"),
        "account",
        "region",
        F.unix_seconds("event_ts").alias("epoch"),
        "year",
        "month",
        "day",
        "hour",
        F.col("eventSource").alias("event_source"),
        F.col("eventName").alias("event_name"),
        F.col("userIdentity.type").alias("identity_type"),
        F.col("userIdentity.sessionContext.sessionIssuer.principalId").alias("principal_id"),
        F.get_json_object("requestParameters", "$.k").alias("k"),
        F.col("readOnly").alias("read_only"),
        F.col("resources")[0]["accountId"].alias("resource_account"),
    )


@registered(
    f"""
WITH {VIEWS}, {PLACED}
SELECT DISTINCT account, event_source, event_name,
       CASE WHEN identity_type = 'AssumedRole' THEN principal_id ELSE '' END AS principal_id,
       identity_type
FROM placed
WHERE event_ts >= TIMESTAMP '2024-01-14 12:00:00' AND event_ts < TIMESTAMP '2024-01-15 12:00:00'
  AND region IN ('ap-northeast-1', 'ap-south-1')"""
)
def audit_partition_scan(spark, sf_dir):
    """A day's window over the audit table, only its dates
    listed and some regions kept."""
    settings = Settings(window=86400, regions=("ap-northeast-1", "ap-south-1"))
    records = read_audit_table(
        spark, ingested_table(spark, sf_dir), audit.spanned_days(RUN, settings)
    )
    window = activity.trailing_window(activity.calls_of(records), RUN, settings)
    return activity.distinct_calls(window)
