"""What counts as new.

An action of a role is new at a tick iff the role has not done it before, or
last did it more than ``ttl`` seconds earlier.  ``decide`` answers that for one
tick against a stored baseline, ``first_or_lapsed`` for all ticks at once,
``sessions`` states the same as sessions, and the streaming package keeps the
last tick in state.  Tests hold them to one another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolehabit.functions.moments import expiry
from rolehabit.schemas import BASELINE_KEY
from rolehabit.sources.baseline import live

KEY = list(BASELINE_KEY)


def decide(seen: DataFrame, baseline: DataFrame, run_epoch: int) -> DataFrame:
    """Flag each seen action with ``is_new``: one outer join serves both the
    report (misses) and the refresh (hits)."""
    known = live(baseline, run_epoch).select(*KEY, F.lit(True).alias("_known"))
    return (
        seen.join(known, KEY, "left")
        .withColumn("is_new", F.col("_known").isNull())
        .drop("_known")
    )


def new_actions(seen: DataFrame, baseline: DataFrame, run_epoch: int) -> DataFrame:
    return seen.join(live(baseline, run_epoch), KEY, "left_anti")


def known_actions(seen: DataFrame, baseline: DataFrame, run_epoch: int) -> DataFrame:
    return seen.join(live(baseline, run_epoch), KEY, "left_semi")


def merge(baseline: DataFrame, seen: DataFrame, run_epoch: int, ttl: int) -> DataFrame:
    """The next baseline: seen actions expire ``ttl`` after this tick, the others
    keep their expiry, expired ones are dropped.

    A full outer join rather than a union and aggregate, because a bucketed
    baseline then stays where it is.
    """
    refreshed = seen.select(*KEY, expiry(F.col("tick"), ttl).alias("_ttl"))
    return (
        live(baseline, run_epoch)
        .join(refreshed, KEY, "full_outer")
        .select(*KEY, F.greatest("_ttl", "ttl").alias("ttl"))
    )


def first_or_lapsed(occurrences: DataFrame, ttl: int, keys: list[str] = KEY) -> DataFrame:
    """All new occurrences over all ticks; input is distinct per key and tick.

    Being distinct is what bounds a window group: a key has at most one row per
    tick, however many events it had.
    """
    previous = F.lag("tick").over(Window.partitionBy(*keys).orderBy("tick"))
    return (
        occurrences.withColumn("_previous", previous)
        .where(F.col("_previous").isNull() | (F.col("tick") - F.col("_previous") > ttl))
        .drop("_previous")
    )


def first_or_lapsed_in_blocks(
    occurrences: DataFrame, ttl: int, block: int, keys: list[str] = KEY
) -> DataFrame:
    """The same for ticks so fine (raw event times) that one key may hold a large
    share of all rows; repeats are allowed.

    Time is cut into blocks of ``block`` seconds, at least ``ttl``.  The first
    window runs inside a key's block, so a hot key is spread over its blocks.
    What it keeps are the rows after a gap and each block's first row, which has
    yet to be compared with the last tick of the key's block before; a gap being
    longer than ``ttl``, that is two rows per block at most for the second window.
    """
    inside = Window.partitionBy(*keys, "_block")
    kept = (
        occurrences.select(*keys, "tick")
        .withColumn("_block", F.col("tick") - F.pmod("tick", F.lit(block)))
        .withColumns(
            {
                "_previous": F.lag("tick").over(inside.orderBy("tick")),
                "_last": F.max("tick").over(inside),
            }
        )
        .where(F.col("_previous").isNull() | (F.col("tick") - F.col("_previous") > ttl))
    )
    before = F.lag("_last").over(Window.partitionBy(*keys).orderBy("tick"))
    gap = F.col("tick") - F.coalesce("_previous", "_before")
    return (
        kept.withColumn("_before", before)
        .where(gap.isNull() | (gap > ttl))
        .select(*keys, "tick")
    )


def sessions(occurrences: DataFrame, ttl: int, keys: list[str] = KEY) -> DataFrame:
    """Sessions of a key with gaps up to ``ttl``; each start is a new occurrence."""
    span = F.session_window(F.timestamp_seconds("tick"), f"{ttl} seconds")
    grouped = occurrences.groupBy(*keys, span.alias("span")).agg(F.count("*").alias("ticks"))
    return grouped.select(
        *keys,
        F.unix_seconds("span.start").alias("tick"),
        (F.unix_seconds("span.end") - ttl).alias("last_tick"),
        "ticks",
    )


def baseline_as_of(occurrences: DataFrame, run_epoch: int, ttl: int) -> DataFrame:
    """The baseline sequential ticks up to ``run_epoch`` would have left: since a
    hit only moves the expiry forward, that is the last tick per key.  Repeats in
    the input do no harm; they go in the partial aggregate."""
    account = [c for c in ("account",) if c in occurrences.columns]
    last = F.max("tick")
    return live(
        occurrences.where(F.col("tick") <= run_epoch)
        .groupBy(*account, *KEY)
        .agg(expiry(last, ttl).alias("ttl")),
        run_epoch,
    )
