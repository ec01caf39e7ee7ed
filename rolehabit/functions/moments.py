"""Times.  A run has one ``run_ts``; a tick is its epoch second."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def as_utc(run_ts: datetime) -> datetime:
    """A naive time counts as UTC."""
    return run_ts.replace(tzinfo=timezone.utc) if run_ts.tzinfo is None else run_ts


def epoch_micros(run_ts: datetime) -> int:
    return (as_utc(run_ts) - EPOCH) // timedelta(microseconds=1)


def epoch_of(run_ts: datetime) -> int:
    return epoch_micros(run_ts) // 1_000_000


def moment(run_ts: datetime, dtype: str = "timestamp") -> Column:
    """``run_ts`` as a literal of the column type it is compared with, so that
    the cast falls on the literal and the comparison reaches the scan."""
    return F.timestamp_micros(F.lit(epoch_micros(run_ts))).cast(dtype)


def seconds_of(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def tick_after(ts: Column, period: int) -> Column:
    """The run that first sees ``ts`` when runs are ``period`` seconds apart and
    each looks at the period before it: the end of the enclosing interval."""
    seconds = seconds_of(ts)
    return seconds - F.pmod(seconds, F.lit(period)) + F.lit(period).cast("bigint")


def expiry(tick: Column, ttl: int) -> Column:
    return tick + F.lit(ttl).cast("bigint")


def date_keys(ts: Column) -> dict[str, Column]:
    """Zero-padded partition values of a time."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def epoch_fraction(ts: Column) -> Column:
    """Seconds with microseconds, as a decimal so that JSON shows plain digits."""
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)")
    return (micros / F.lit(1_000_000)).cast("decimal(17,6)")
