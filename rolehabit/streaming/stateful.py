"""New actions from keyed state: a ``last_seen`` tick per role and action, kept by slices of
a role's actions."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from rolehabit.schemas import OCCURRENCE
from rolehabit.settings import Settings

FLUSH_ROWS = 200_000
#: Parts of a role's actions with state of their own, which spread a busy role over tasks.
#: A checkpoint holds for one number only.
SLICES = 8

# Python workers get this module's code with the job, installed there or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LastSeen(StatefulProcessor):
    """Emits the ticks at which an action is new and remembers the last one of each.

    A key is a role and a slice of its actions: every key costs calls to the state store
    and a batch of its own, so one per action would cost more than the actions themselves.
    Ticks are compared with one another, so history replays exactly.  With ``evict``
    actions left untouched for ``ttl`` seconds of processing time are forgotten, which a
    live job needs to keep its state small.
    """

    def __init__(self, ttl: int, evict: bool):
        self.ttl = ttl
        self.evict = evict

    def init(self, handle) -> None:
        keep = {"ttlDurationMs": self.ttl * 1000} if self.evict else {}
        self.last = handle.getListState("last_seen", "action STRING, tick BIGINT, touched BIGINT", **keep)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.evict else 0
        last = {action: (tick, touched) for action, tick, touched in self.last.get()}
        if self.evict:
            last = {action: seen for action, seen in last.items() if seen[1] + self.ttl * 1000 > now}
        for action, tick in sorted({(row.action, row.tick) for row in rows}, key=_in_time):
            before = last[action][0] if action in last else None
            if before is None or (tick is not None and tick - before > self.ttl):
                yield Row(role_id=key[0], action=action, tick=tick)
            ticks = [t for t in (before, tick) if t is not None]
            last[action] = (max(ticks, default=None), now)
        self.last.put([(action, *seen) for action, seen in last.items()])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        now = timerValues.getCurrentProcessingTimeInMs() if self.evict else 0
        self.last.put([(entry["action"], entry["tick"], now) for entry in initialState.entries])

    def close(self) -> None:
        pass


def _in_time(seen: tuple) -> tuple:
    """By tick within an action, an unknown tick last."""
    action, tick = seen
    return action is None, action or "", tick is None, tick or 0


def without_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop repeated rows of a partition before anything is shuffled.

    State handles repeats anyway; this keeps a hot key from sending all its
    events to one task.  Memory is bounded by flushing: no more than ``FLUSH_ROWS``
    rows and a batch are held.
    """
    waiting, rows = [], 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows < FLUSH_ROWS:
            continue
        waiting = _distinct(waiting).to_batches()
        rows = sum(b.num_rows for b in waiting)
        if 2 * rows >= FLUSH_ROWS:  # else there are many repeats, and room for more
            yield from waiting
            waiting, rows = [], 0
            pa.default_memory_pool().release_unused()
    if waiting:
        yield from _distinct(waiting).to_batches()


def _distinct(batches: list[pa.RecordBatch]) -> pa.Table:
    table = pa.Table.from_batches(batches)
    return table.group_by(table.column_names).aggregate([])


def new_actions(
    actions: DataFrame,
    settings: Settings = Settings(),
    evict: bool = False,
    baseline: DataFrame | None = None,
) -> DataFrame:
    """Stream of new ``(role_id, action, tick)`` from a stream of such rows.

    ``baseline`` seeds the state of a first start.  It must not be a bucketed
    scan (see ``BaselineStore.load``): Spark would rely on the bucketing to place
    the rows, and then drop it from a plan only a stateful operator uses.
    """
    piece = F.pmod(F.xxhash64("action"), F.lit(SLICES)).cast("int").alias("slice")
    keys = ["role_id", "slice"]
    seed = None
    if baseline is not None:
        entry = F.struct("action", (F.col("ttl") - settings.ttl).alias("tick"))
        # one row a key: its own actions, as many as its state holds anyway
        seed = baseline.groupBy("role_id", piece).agg(F.collect_list(entry).alias("entries")).groupBy(*keys)
    return (
        actions.select(*OCCURRENCE.names, piece)
        .groupBy(*keys)
        .transformWithState(
            LastSeen(settings.ttl, evict),
            OCCURRENCE,
            "Update",
            "processingTime" if evict else "None",
            seed,
        )
    )
