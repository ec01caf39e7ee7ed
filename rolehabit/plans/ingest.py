"""Audit files to audit table, bad input to the quarantine."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import SparkSession

from rolehabit.functions.moments import epoch_of, moment
from rolehabit.settings import Settings
from rolehabit.sinks.emission import error_lines, run_folder, write_lines
from rolehabit.sources import audit
from rolehabit.sources.folders import remove


def ingest_days(
    spark: SparkSession,
    base: str,
    days: Iterable[date],
    table: str,
    output: str,
    run_ts: datetime,
    settings: Settings = Settings(),
) -> None:
    """Flatten all files of some days into the table, replacing what an earlier
    run made of those days, and write what could not be read as error events.

    For a day still filling up use ``streaming.jobs.start_ingest``, which takes
    each file once.
    """
    days = list(days)
    paths = audit.day_folders(base, days, regions=settings.regions)
    for day in days:  # a file repaired since is no longer an error
        remove(spark, audit.day_folder(audit.unreadable_folder(table), day))
    flat = audit.flatten(audit.read_audit_files(spark, paths))
    audit.write_audit_table(flat, table, mode="overwrite")
    bad = audit.read_unreadable(spark, table, days)
    write_lines(
        error_lines(bad, moment(run_ts), settings),
        run_folder(output, "errors", epoch_of(run_ts)),
    )
