"""Audit logs: nested JSON files in, one flat Parquet table out.

The files hold ``{"Records": [...]}`` under
``{base}/{account}/CloudTrail/{region}/{yyyy}/{MM}/{dd}/``.  Columns are not
pruned through the ``Records`` array, so files are flattened once into a table
of one row per record and every tick reads that table instead.

The table is partitioned by the file's date and the record's hour, so that
re-ingesting a date replaces exactly what its files gave.  Account and region stay ordinary,
sorted columns: a folder per account, region and hour would mean millions of
small files, while row-group statistics on sorted columns prune as well.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolehabit.functions.moments import as_utc, date_keys
from rolehabit.schemas import (
    AUDIT_FILE,
    AUDIT_RECORD,
    AUDIT_TABLE,
    CORRUPT,
    JSON_KEYS,
    PARTITIONS,
    UNREADABLE,
)
from rolehabit.settings import Settings
from rolehabit.sources.folders import matches

# also matches copies kept under account=…/region=…/year=…/month=…/day=…
_LAYOUT = (
    r"/(?:account=)?([^/]+)/(?:CloudTrail/)?(?:region=)?([^/]+)"
    r"/(?:year=)?(\d{4})/(?:month=)?(\d{2})/(?:day=)?(\d{2})/[^/]+$"
)
_PATH_PARTS = ("account", "region", "year", "month", "day")


def spanned_days(run_ts: datetime, settings: Settings = Settings()) -> list[date]:
    """Dates a tick's window touches: two just after midnight, else one."""
    last = as_utc(run_ts)
    first = last if settings.today_only else last - timedelta(seconds=settings.window)
    count = (last.date() - first.date()).days + 1
    return [first.date() + timedelta(days=n) for n in range(count)]


def day_folders(
    base: str, days: Iterable[date], accounts: Iterable[str] = (), regions: Iterable[str] = ()
) -> list[str]:
    """Globs of the audit folders of some days, optionally of some accounts and regions."""

    def one_of(names: Iterable[str]) -> str:
        names = list(names)
        return "{" + ",".join(names) + "}" if names else "*"

    prefix = f"{base.rstrip('/')}/{one_of(accounts)}/CloudTrail/{one_of(regions)}"
    return [f"{prefix}/{day:%Y/%m/%d}" for day in days]


def read_audit_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file; folders without a match are left out."""
    present = [path for path in paths if matches(spark, path)]
    if not present:
        return spark.createDataFrame([], AUDIT_FILE).withColumn("file", F.lit(""))
    return _json_files(spark.read).json(present).withColumn("file", _file_name())


def read_files_below(spark: SparkSession, folder: str) -> DataFrame:
    """Every audit file below a folder, whatever its day."""
    reader = _json_files(spark.read).option("recursiveFileLookup", True)
    return reader.json(folder).withColumn("file", _file_name())


def stream_audit_files(spark: SparkSession, base: str, files_per_trigger: int | None = None):
    """The same rows from a stream that picks each file up once, late ones included.

    A micro-batch takes all files that wait, unless a number is given.
    """
    pattern = f"{base.rstrip('/')}/*/CloudTrail/*/*/*/*"
    reader = _json_files(spark.readStream)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(pattern).withColumn("file", _file_name())


#: Stands in no file, so a file is one line.
_NEVER = "\x1e5c0f9a4e-end-of-file-0b7d\x1e"


def _json_files(reader):
    """A document per file, as one long line: with ``multiLine`` Spark goes back to the file for
    the text of every nested object that is kept as JSON (``requestParameters``)."""
    return (
        reader.schema(AUDIT_FILE)
        .option("lineSep", _NEVER)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )


def _file_name():
    return F.col("_metadata.file_path")


def flatten(files: DataFrame) -> DataFrame:
    """One row per record: account, region and date of the file's folder, and
    the hour of the record's own time.

    What cannot be read is a row too, with a ``reason`` and the ``content`` at
    fault, so that files are parsed once for the table and the quarantine.
    """
    whole = files.schema["Records"].dataType.elementType
    text = F.lit(None).cast("string")
    good = F.transform(
        F.coalesce("Records", F.array().cast(T.ArrayType(whole))),
        lambda record: F.struct(record.alias("record"), text.alias("_text"), text.alias("_file")),
    )
    # a record of which a part did not fit leaves the rest of its file readable
    fault = F.struct(
        F.lit(None).cast(whole).alias("record"),
        F.coalesce(F.col(CORRUPT), F.lit("")).alias("_text"),
        F.col("file").alias("_file"),
    )
    faulty = F.col("Records").isNull() | F.col(CORRUPT).isNotNull()
    rows = F.when(faulty, F.concat(good, F.array(fault))).otherwise(good)
    parts = [
        F.regexp_extract("file", _LAYOUT, place).alias(name)
        for place, name in enumerate(_PATH_PARTS, 1)
    ]
    # the array itself must not stand beside its records: each of them would carry all
    nothing = F.col("Records").isNull().alias("_nothing")
    records = (
        files.select(*parts, nothing, rows.alias("_rows"))
        .select(*_PATH_PARTS, "_nothing", F.inline("_rows"))
        .select("*", "record.*")
    )
    event_ts = F.try_to_timestamp("eventTime")
    reason = (
        F.when(F.col("_text").isNotNull() & F.col("_nothing"), "unreadable file")
        .when(F.col("_text").isNotNull(), "half-read record")
        .when(event_ts.isNull(), "unreadable time")
    )
    return records.select(
        *[F.col(JSON_KEYS.get(name, name)).alias(name) for name in AUDIT_RECORD.names],
        "account",
        "region",
        event_ts.alias("event_ts"),
        "year",
        "month",
        "day",
        date_keys(event_ts)["hour"].alias("hour"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.coalesce("_file", "eventID", F.lit(""))).alias("origin"),
        F.when(reason.isNotNull(), F.coalesce("_text", "eventTime", F.lit(""))).alias("content"),
    )


def readable(flat: DataFrame) -> DataFrame:
    return flat.where(F.col("reason").isNull()).drop(*UNREADABLE)


def by_readability(flat: DataFrame) -> DataFrame:
    """The table's outermost partition: whether a row is a record or quarantined."""
    return flat.withColumn("readable", F.col("reason").isNull().cast("string"))


def write_audit_table(
    flat: DataFrame,
    path: str,
    mode: str = "append",
    partitions: tuple[str, ...] = PARTITIONS,
) -> None:
    """Write the table.  The rebalance hint shuffles by partition value but lets
    adaptive execution split a large hour and merge small ones, so neither a
    busy hour nor a quiet one decides the file size.

    Below some 100 MB an hour, folders per day (``PARTITIONS[:3]``) are enough;
    the hour is then an ordinary column.
    """
    folders = ("readable", *partitions)
    (
        by_readability(flat)
        .hint("rebalance", *folders)
        .sortWithinPartitions(*folders, "account", "event_ts")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def read_audit_table(
    spark: SparkSession, path: str, days: Iterable[date] | None = None
) -> DataFrame:
    """The records of the table, or of some days of it without listing the others."""
    return _read_part(spark, f"{path}/readable=true", AUDIT_TABLE, days)


def read_unreadable(
    spark: SparkSession, path: str, days: Iterable[date] | None = None
) -> DataFrame:
    """What could not be read, as ``(reason, origin, content)`` for the quarantine."""
    schema = T.StructType(
        [T.StructField(n, T.StringType()) for n in (*UNREADABLE, *PARTITIONS)]
    )
    return _read_part(spark, unreadable_folder(path), schema, days).select(*UNREADABLE)


def unreadable_folder(path: str) -> str:
    return f"{path}/readable=false"


def day_folder(root: str, day: date) -> str:
    return f"{root}/year={day:%Y}/month={day:%m}/day={day:%d}"


def _read_part(
    spark: SparkSession, root: str, schema: T.StructType, days: Iterable[date] | None
) -> DataFrame:
    wanted = [root] if days is None else [day_folder(root, day) for day in days]
    present = [folder for folder in wanted if matches(spark, folder)]
    if not present:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*present)
