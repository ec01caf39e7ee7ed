"""JSON texts handed to the alert consumer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolehabit.schemas import ALERT_FIELDS
from rolehabit.settings import Settings

_KEEP_NULLS = {"ignoreNullFields": "false"}


def alert_json(settings: Settings = Settings()) -> Column:
    """The fourteen fields of an alert, in order."""
    fields = {name: F.col(name) for name in ALERT_FIELDS}
    if settings.owner_as_list:
        fields["account_owner"] = F.array("account_owner")
    return F.to_json(
        F.struct(*[value.alias(name) for name, value in fields.items()]), _KEEP_NULLS
    )


def envelope(event: Column, sourcetype: str, time: Column, settings: Settings) -> Column:
    """Envelope around an event that is itself JSON text (so encoded twice)."""
    return F.to_json(
        F.struct(
            F.lit(settings.index).alias("index"),
            F.lit(sourcetype).alias("sourcetype"),
            event.alias("event"),
            time.alias("time"),
        ),
        _KEEP_NULLS,
    )


def topic_message(payload: Column) -> Column:
    """The form a topic wants: the payload under the key ``default``."""
    return F.to_json(F.struct(payload.alias("default")))


def error_json(note: Column, response: Column, detail: Column) -> Column:
    return F.to_json(
        F.struct(
            note.alias("error_note"),
            response.alias("query_response"),
            detail.alias("note"),
        ),
        _KEEP_NULLS,
    )
