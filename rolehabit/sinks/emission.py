"""Alerts and errors as JSON lines in a folder, one subfolder per run.

A run's folder is replaced as a whole, so repeating a run repeats its output
rather than adding to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolehabit.functions.moments import epoch_fraction
from rolehabit.functions.payloads import alert_json, envelope, error_json, topic_message
from rolehabit.settings import ALERT_SOURCETYPE, ERROR_SOURCETYPE, Settings


def alert_lines(alerts: DataFrame, time: Column, settings: Settings = Settings()) -> DataFrame:
    """One enveloped alert per row, in a column ``value``."""
    body = envelope(alert_json(settings), ALERT_SOURCETYPE, epoch_fraction(time), settings)
    return _in_form(alerts.select(body.alias("value")), settings)


def error_lines(quarantine: DataFrame, time: Column, settings: Settings = Settings()) -> DataFrame:
    """Quarantined rows ``(reason, origin, content)`` in the same envelope under
    the error source type."""
    event = error_json(F.col("reason"), F.col("content"), F.col("origin"))
    body = envelope(event, ERROR_SOURCETYPE, epoch_fraction(time), settings)
    return _in_form(quarantine.select(body.alias("value")), settings)


def _in_form(lines: DataFrame, settings: Settings) -> DataFrame:
    return for_topic(lines) if settings.topic else lines


def for_topic(lines: DataFrame) -> DataFrame:
    return lines.select(topic_message(F.col("value")).alias("value"))


def run_folder(root: str, kind: str, run_epoch: int) -> str:
    return f"{root.rstrip('/')}/{kind}/run={run_epoch}"


def write_lines(lines: DataFrame, folder: str) -> None:
    lines.write.mode("overwrite").text(folder)
