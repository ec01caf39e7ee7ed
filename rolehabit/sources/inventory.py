"""Account and role inventories, read from exports of the whole organization."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.functions.moments import date_keys, moment, seconds_of
from rolehabit.functions.texts import is_listed
from rolehabit.functions.trust import first_principal
from rolehabit.schemas import ACCOUNT_EXPORT, ROLE_EXPORT, WORK_ITEM
from rolehabit.settings import Settings


def latest(rows: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row per key.  An aggregate rather than a window: copies of a
    much-repeated key are dropped before the shuffle."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.max_by(whole, order).alias("_last")).select("_last.*")


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    export = spark.read.schema(ACCOUNT_EXPORT).json(path)
    return accounts_of(export.withColumn("_seq", _file_order()), F.col("_seq"))


def accounts_of(export: DataFrame, order: Column) -> DataFrame:
    """Accounts by id, the last record of an id winning among active ones."""
    active = export.where(F.col("Status") == "ACTIVE")
    return latest(active.withColumn("_order", order), "Id", F.col("_order")).select(
        F.col("Id").alias("account"),
        F.col("Name").alias("account_name"),
        F.col("Email").alias("account_owner"),
        F.col("Status").alias("status"),
    )


def read_roles(spark: SparkSession, path: str) -> DataFrame:
    export = spark.read.schema(ROLE_EXPORT).json(path)
    return roles_of(export.withColumn("_seq", _file_order()), F.col("_seq"))


def roles_of(export: DataFrame, order: Column) -> DataFrame:
    """Roles by ARN, the last record of an ARN winning."""
    document = F.struct(*[F.col(name) for name in ROLE_EXPORT.names if name != "account"])
    return latest(export.withColumn("_order", order), "Arn", F.col("_order")).select(
        F.col("RoleId").alias("role_id"),
        F.col("RoleName").alias("role_name"),
        "account",
        F.col("Arn").alias("role_arn"),
        seconds_of(F.col("CreateDate")).alias("create_epoch"),
        first_principal(F.col("AssumeRolePolicyDocument")).alias("principal_json"),
        F.to_json(document).alias("role_doc"),
    )


def _file_order() -> Column:
    """Later files, and later lines of a file, count as newer."""
    return F.struct(
        F.col("_metadata.file_modification_time"),
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    )


def usable_roles(roles: DataFrame) -> DataFrame:
    return roles.where(F.col("principal_json").isNotNull())


def roles_without_principal(roles: DataFrame) -> DataFrame:
    """Roles whose policy names no principal in its first statement, for the quarantine."""
    return roles.where(F.col("principal_json").isNull()).select(
        F.lit("no principal in first statement").alias("reason"),
        F.col("role_arn").alias("origin"),
        F.col("role_doc").alias("content"),
    )


def selected_accounts(accounts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Active accounts of the wanted business that are not on the skip list."""
    kept = accounts.where(F.col("status") == "ACTIVE").where(
        ~is_listed(F.col("account"), settings.skipped_accounts)
    )
    token = settings.business_token
    if token is None:
        return kept
    return kept.where(F.lower("account_name").contains(token)).withColumn(
        "business", F.lit(token)
    )


def with_constants(accounts: DataFrame, business: str, ct_bucket: str) -> DataFrame:
    """Give every account the same business and log bucket."""
    return accounts.withColumns(
        {"business": F.lit(business), "ct_bucket": F.lit(ct_bucket)}
    )


def work_items(accounts: DataFrame, run_ts: datetime) -> DataFrame:
    """One message per account, as JSON text: the run's date and the account's fields."""
    keys = date_keys(moment(run_ts))
    message = F.to_json(
        F.struct(
            F.col("account"),
            F.array(keys["year"], keys["month"], keys["day"]).alias("current_date"),
            F.col("ct_bucket"),
            F.col("business"),
            F.col("account_owner").alias("owner"),
            F.col("account_name").alias("name"),
        )
    )
    return accounts.select(F.array(message).alias("messages"))


def parse_work_items(items: DataFrame) -> DataFrame:
    """Parameters out of messages; only the first message of a delivery counts."""
    parsed = items.select(F.from_json(F.get("messages", F.lit(0)), WORK_ITEM).alias("item"))
    day = F.col("item.current_date")
    return parsed.select(
        "item.account",
        day[0].alias("year"),
        day[1].alias("month"),
        day[2].alias("day"),
        "item.ct_bucket",
        "item.business",
        F.col("item.owner").alias("account_owner"),
        F.col("item.name").alias("account_name"),
    )
