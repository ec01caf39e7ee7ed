"""New actions from state kept per role: all its actions, and whether it is in the inventory.

State is read and written once for each role of a micro-batch, however many actions it
has.  Inventory changes may come as a second stream (see ``sources.versions``): a role
counts from the change that adds it on, and what it did before is neither learned nor
reported.

A role is one key, so all its actions are handled in one task; repeats are dropped per
partition before.  Where single roles do more distinct things than a task can take, use
``streaming.stateful``, which is keyed by role and action.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from rolehabit.schemas import OCCURRENCE
from rolehabit.settings import Settings

# Python workers get this module's code with the job, installed there or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RoleMemory(StatefulProcessor):
    """Emits the ticks at which an action of a role is new.

    With ``evict`` a timer per role drops actions left untouched for ``ttl`` seconds of
    processing time.  With ``follows`` rows without an action are inventory changes.
    """

    def __init__(self, ttl: int, evict: bool, follows: bool):
        self.ttl = ttl
        self.evict = evict
        self.follows = follows

    def init(self, handle) -> None:
        self.handle = handle
        self.actions = handle.getListState("actions", "action STRING, tick BIGINT")
        if self.follows:
            self.member = handle.getValueState("member", "account STRING, present BOOLEAN, version BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen, change = set(), None
        for row in rows:
            if row.action is not None:
                seen.add((row.action, row.tick, row.account))
            elif change is None or row.version >= change[2]:
                change = (row.account, row.present, row.version)
        if self.follows:
            account, present = self._membership(change)
            seen = {s for s in seen if present and s[2] in (None, account)}
        if not seen:
            return
        last = {action: tick for action, tick in self.actions.get()}
        oldest = min(last.values(), default=None)
        for action, tick in sorted({s[:2] for s in seen}):
            before = last.get(action)
            if before is None or tick - before > self.ttl:
                yield Row(role_id=key[0], action=action, tick=tick)
            last[action] = tick if before is None else max(before, tick)
        self.actions.put(list(last.items()))
        if self.evict and min(last.values()) != oldest:
            self._wake(min(last.values()), timerValues)

    def _membership(self, change) -> tuple[str | None, bool]:
        known = self.member.get()
        if change is not None and (known is None or change[2] >= known[2]):
            self.member.update(change)
            known = change
        return (known[0], known[1]) if known is not None else (None, False)

    def _wake(self, tick: int, timerValues) -> None:
        now = timerValues.getCurrentProcessingTimeInMs()
        self.handle.registerTimer(max((tick + self.ttl) * 1000, now) + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        kept = [tuple(entry) for entry in self.actions.get() if (entry[1] + self.ttl) * 1000 >= now]
        if kept:
            self.actions.put(kept)
            self._wake(min(tick for _, tick in kept), timerValues)
        else:
            self.actions.clear()
        return iter(())

    def handleInitialState(self, key, initialState, timerValues) -> None:
        entries = [(entry["action"], entry["tick"]) for entry in initialState.entries]
        self.actions.put(entries)
        if self.evict:
            self._wake(min(tick for _, tick in entries), timerValues)

    def close(self) -> None:
        pass


def remembered(
    actions: DataFrame,
    settings: Settings = Settings(),
    evict: bool = False,
    baseline: DataFrame | None = None,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Stream of new ``(role_id, action, tick)`` from a stream of such rows.

    ``changes`` is a stream of inventory changes; without it every role counts.
    ``baseline`` seeds the state of a first start (not a bucketed scan, see
    ``streaming.stateful.new_actions``); its roles still have to be in the inventory.
    """
    none = {"account": "string", "present": "boolean", "version": "bigint"}
    missing = {c: F.lit(None).cast(t) for c, t in none.items() if c not in actions.columns}
    rows = actions.withColumns(missing).select(*OCCURRENCE.names, *none)
    if changes is not None:
        blank = {"action": F.lit(None).cast("string"), "tick": F.lit(None).cast("bigint")}
        rows = rows.unionByName(changes.withColumns(blank))
    seed = None
    if baseline is not None:
        entry = F.struct("action", (F.col("ttl") - settings.ttl).alias("tick"))
        # one row a role: its own actions, as many as its state holds anyway
        seed = baseline.groupBy("role_id").agg(F.collect_list(entry).alias("entries")).groupBy("role_id")
    return rows.groupBy("role_id").transformWithState(
        RoleMemory(settings.ttl, evict, changes is not None),
        OCCURRENCE,
        "Update",
        "processingTime" if evict else "None",
        seed,
    )
