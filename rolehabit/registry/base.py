"""Registration, and the audit-shaped views of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.session import prepare
from rolehabit.settings import DAY, Settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

WEEKLY = Settings(ttl=7 * DAY, window=DAY)
"""Thirty days of events need a shorter memory and a longer tick than the defaults."""


def registered(sql: str | None = None, name: str | None = None):
    def keep(query: Query) -> Query:
        key = name or query.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(prepare(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return query

    return keep


TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its schema declared, which spares a job per read."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


# --- views, Spark side ------------------------------------------------------


def fx_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    status = F.when(F.col("n_nationkey") % 6 == 5, "SUSPENDED").otherwise("ACTIVE")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("account"),
        F.col("n_name").alias("account_name"),
        F.concat(F.lower("n_name"), F.lit("@example.com")).alias("account_owner"),
        F.col("r_name").alias("business"),
        status.alias("status"),
    )


PRINCIPALS = {
    "BUILDING": '{"Service":"ec2.amazonaws.com"}',
    "AUTOMOBILE": '{"Federated":"arn:aws:iam::1:saml-provider/IDP"}',
    "MACHINERY": '{"Federated":"vendor.example.com"}',
    "FURNITURE": '{"AWS":["arn:aws:iam::2:root","arn:aws:iam::3:root"]}',
}
IDP = "saml-provider/IDP"


def fx_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    principal = F.lit('"*"')
    for segment, text in PRINCIPALS.items():
        principal = F.when(F.col("c_mktsegment") == segment, text).otherwise(principal)
    path = F.when(F.col("c_custkey") % 20 == 0, "aws-service-role/").otherwise("")
    account = F.col("c_nationkey").cast("string")
    arn = F.concat(F.lit("arn:aws:iam::"), account, F.lit(":role/"), path, F.col("c_name"))
    roles = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("role_id"),
        F.col("c_name").alias("role_name"),
        account.alias("account"),
        arn.alias("role_arn"),
        (F.lit(1704067200) - DAY * (F.col("c_custkey") % 30)).alias("create_epoch"),
        principal.alias("principal_json"),
    )
    document = F.struct(
        F.col("role_arn").alias("Arn"),
        F.col("role_name").alias("RoleName"),
        F.col("role_id").alias("RoleId"),
        F.col("principal_json").alias("Principal"),
    )
    return roles.withColumn("role_doc", F.to_json(document))


def fx_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls_from(table(spark, sf_dir, "events"))


def calls_from(events: DataFrame, *kept: str) -> DataFrame:
    last_digit = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 10
    kind = F.col("user_id") % 10
    identity = (
        F.when(kind == 7, "AWSService").when(kind == 8, "Root").when(kind == 9, "IAMUser")
    ).otherwise("AssumedRole")
    return events.select(
        "event_id",
        F.col("ts").alias("event_ts"),
        F.col("user_id").cast("string").alias("principal_id"),
        F.concat(F.lit("svc"), last_digit.cast("string"), F.lit(".example.com")).alias(
            "event_source"
        ),
        F.col("event_type").alias("event_name"),
        identity.alias("identity_type"),
        *kept,
    )


# --- views, SQL side --------------------------------------------------------

VIEWS = """
fx_accounts AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS account, n_name AS account_name,
         concat(lower(n_name), '@example.com') AS account_owner, r_name AS business,
         CASE WHEN n_nationkey % 6 = 5 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status
  FROM nation JOIN region ON n_regionkey = r_regionkey),
fx_roles_bare AS (
  SELECT CAST(c_custkey AS VARCHAR) AS role_id, c_name AS role_name,
         CAST(c_nationkey AS VARCHAR) AS account,
         concat('arn:aws:iam::', CAST(c_nationkey AS VARCHAR), ':role/',
                CASE WHEN c_custkey % 20 = 0 THEN 'aws-service-role/' ELSE '' END,
                c_name) AS role_arn,
         CAST(1704067200 - 86400 * (c_custkey % 30) AS BIGINT) AS create_epoch,
         CASE c_mktsegment
           WHEN 'BUILDING'   THEN '{"Service":"ec2.amazonaws.com"}'
           WHEN 'AUTOMOBILE' THEN '{"Federated":"arn:aws:iam::1:saml-provider/IDP"}'
           WHEN 'MACHINERY'  THEN '{"Federated":"vendor.example.com"}'
           WHEN 'FURNITURE'  THEN '{"AWS":["arn:aws:iam::2:root","arn:aws:iam::3:root"]}'
           ELSE '"*"' END AS principal_json
  FROM customer),
fx_roles AS (
  SELECT *, CAST(json_object('Arn', role_arn, 'RoleName', role_name, 'RoleId', role_id,
                             'Principal', principal_json) AS VARCHAR) AS role_doc
  FROM fx_roles_bare),
fx_audit AS (
  SELECT event_id, ts AS event_ts, CAST(user_id AS VARCHAR) AS principal_id,
         concat('svc', CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 10 AS VARCHAR),
                '.example.com') AS event_source,
         event_type AS event_name,
         CASE user_id % 10 WHEN 7 THEN 'AWSService' WHEN 8 THEN 'Root'
                           WHEN 9 THEN 'IAMUser' ELSE 'AssumedRole' END AS identity_type
  FROM events)"""

DAILY = """
occ AS (
  SELECT DISTINCT principal_id AS role_id, event_source || ':' || event_name AS action,
         CAST((epoch_us(event_ts) // 86400000000 + 1) * 86400 AS BIGINT) AS tick
  FROM fx_audit
  WHERE identity_type = 'AssumedRole' AND principal_id IN (SELECT role_id FROM fx_roles)),
lagged AS (
  SELECT *, lag(tick) OVER (PARTITION BY role_id, action ORDER BY tick) AS prev FROM occ),
news AS (
  SELECT role_id, action, tick FROM lagged WHERE prev IS NULL OR tick - prev > 604800)"""


def classed(roles: str) -> str:
    """CTE ``classed``: the roles of a relation with their trust class."""
    return f"""
classed AS (
  SELECT *,
         CASE WHEN principal_json LIKE '%"Service"%' THEN 'Service'
              WHEN principal_json LIKE '%"Federated"%' THEN 'Federated'
              WHEN principal_json LIKE '%"AWS"%' THEN 'AWS' ELSE '?' END AS association_type,
         CASE WHEN principal_json LIKE '%"Service"%' THEN 'High'
              WHEN principal_json LIKE '%"Federated"%saml-provider/IDP%' THEN 'Informational'
              WHEN principal_json LIKE '%"Federated"%' THEN 'High'
              WHEN principal_json LIKE '%"AWS"%' THEN 'Medium'
              ELSE 'Informational' END AS base_severity,
         coalesce(json_extract_string(principal_json, '$.Service'),
                  json_extract_string(principal_json, '$.Federated'),
                  json_extract_string(principal_json, '$.AWS'), '?') AS associated_with,
         CASE WHEN principal_json LIKE '%"Service"%' THEN
                'AWS services can be associated with this role. The following service(s) '
                || 'can be associated with this particular role: '
                || json_extract_string(principal_json, '$.Service')
              WHEN principal_json LIKE '%"Federated"%' THEN
                'Federated users can use this role. This means that users must first '
                || 'authenticate outside of aws.'
              WHEN principal_json LIKE '%"AWS"%' THEN
                'This is a role from another account. Someone or thing requested temporary '
                || 'access keys to this account and made API calls.'
              ELSE role_doc END AS association_message
  FROM {roles})"""


def judged(news: str = "news", ignored_role: str = "false") -> str:
    """CTEs ``grp`` and ``judged``: new actions per role and tick, with verdicts."""
    return f"""
grp AS (
  SELECT role_id, tick, string_agg(action, ',' ORDER BY action) AS role_actions,
         list(action ORDER BY action) AS action_list, count(*) AS n_new
  FROM {news} GROUP BY role_id, tick),
{classed('fx_roles')},
flagged AS (
  SELECT g.tick, g.role_actions, g.action_list, g.n_new, c.*,
         CASE WHEN g.n_new < 5 THEN 'Informational' ELSE c.base_severity END AS severity,
         create_epoch > tick - 1296000 AS too_new,
         list_contains(string_split(role_arn, '/'), 'aws-service-role') AS service_linked,
         {ignored_role} AS ignored_role
  FROM grp g JOIN classed c ON g.role_id = c.role_id),
judged AS (
  SELECT *, concat_ws(',', CASE WHEN too_new THEN 'too_new' END,
                      CASE WHEN service_linked THEN 'service_linked' END,
                      CASE WHEN ignored_role THEN 'ignored_role' END) AS skip_reason
  FROM flagged)"""


ALERTS = """
alerts AS (
  SELECT j.tick, j.role_name, j.account, j.role_arn, j.role_id AS "principalId",
         j.role_actions, j.action_list, j.n_new, j.principal_json,
         'CloudTrailAnomaly' AS alert_name,
         'Activity has been detected that is not within the past 90 days '
         || 'baseline activity for this role and account.' AS alert_note,
         j.association_type, j.associated_with, j.association_message, j.severity,
         a.business, a.account_owner, a.account_name
  FROM judged j JOIN fx_accounts a ON j.account = a.account
  WHERE j.skip_reason = '' AND a.status = 'ACTIVE')"""


def over_views(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([VIEWS, *ctes])}\n{body}"
