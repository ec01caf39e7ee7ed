"""Streaming queries: ingest, alerts from keyed state, ticks from micro-batches.

A file source takes each file once, whenever it arrives, so there is no trailing
window and no event is too late.  Inventories come from tables (``sinks.tables.written``):
a stream cannot number export lines.  They are those of the query's start, or follow a
store of versions.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rolehabit.functions.moments import tick_after
from rolehabit.operators import activity, alerts
from rolehabit.plans.tick import roles_in_scope, run_tick
from rolehabit.schemas import PARTITIONS
from rolehabit.settings import HOUR, Settings
from rolehabit.sinks.emission import alert_lines, error_lines, write_lines
from rolehabit.sinks.tables import written
from rolehabit.sources import audit
from rolehabit.sources.baseline import BaselineStore
from rolehabit.sources.folders import create_marker, names_in
from rolehabit.sources.inventory import selected_accounts
from rolehabit.sources.versions import InventoryVersions
from rolehabit.streaming.memory import remembered
from rolehabit.streaming.stateful import new_actions, without_repeats


def hourly() -> dict:
    return {"processingTime": "1 hour"}


def until_caught_up() -> dict:
    return {"availableNow": True}


def role_action_stream(
    calls: DataFrame, roles: DataFrame, period: int = HOUR, settings: Settings = Settings()
) -> DataFrame:
    """Actions of known roles, repeats dropped per partition: a streaming
    ``distinct`` would keep state of its own, and the stateful step does the rest."""
    rows = activity.role_action_rows(activity.on_ticks(activity.in_scope(calls, settings), period))
    return activity.of_known_roles(rows.mapInArrow(without_repeats, rows.schema), roles)


def start_ingest(
    files: DataFrame, table: str, checkpoint: str, trigger: dict, settings: Settings = Settings()
) -> StreamingQuery:
    """Audit files to audit table, each file exactly once."""
    return (
        audit.by_readability(activity.in_scope(audit.flatten(files), settings))
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .partitionBy("readable", *PARTITIONS)
        .trigger(**trigger)
        .start()
    )


def start_errors(
    files: DataFrame, output: str, checkpoint: str, trigger: dict, settings: Settings = Settings()
) -> StreamingQuery:
    """What of the audit files cannot be read, as error events, each exactly once.

    Their time is that of the micro-batch, which a repeated one keeps."""
    faults = audit.flatten(files).where(F.col("reason").isNotNull())
    return (
        error_lines(faults, F.current_timestamp(), settings)
        .writeStream.format("text")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_new_actions(
    calls: DataFrame,
    roles: DataFrame,
    output: str,
    checkpoint: str,
    trigger: dict,
    period: int = HOUR,
    settings: Settings = Settings(),
    evict: bool = False,
    seed: BaselineStore | None = None,
) -> StreamingQuery:
    """New actions to Parquet, one folder per micro-batch.  A first start takes
    over from the snapshots of ``seed``, if given."""
    baseline = seed and seed.load(bucketed=False)
    stream = new_actions(
        role_action_stream(calls, roles, period, settings), settings, evict, baseline
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return _start(stream, write, checkpoint, trigger)


def start_new_actions_by_role(
    calls: DataFrame,
    roles: DataFrame | InventoryVersions,
    output: str,
    checkpoint: str,
    trigger: dict,
    period: int = HOUR,
    settings: Settings = Settings(),
    evict: bool = False,
    seed: BaselineStore | None = None,
) -> StreamingQuery:
    """The same with state kept per role.  Given versions of the inventory, a role counts
    from the micro-batch on that takes in the version adding it."""
    stream = _remembered(calls, roles, period, settings, evict, seed)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return _start(stream, write, checkpoint, trigger)


def _remembered(
    calls: DataFrame, roles: DataFrame | InventoryVersions, period: int, settings: Settings, evict: bool, seed: BaselineStore | None
) -> DataFrame:
    baseline = seed and seed.load(bucketed=False)
    if isinstance(roles, DataFrame):
        return remembered(role_action_stream(calls, roles, period, settings), settings, evict, baseline)
    rows = activity.role_action_rows(activity.on_ticks(activity.in_scope(calls, settings), period))
    rows = rows.mapInArrow(without_repeats, rows.schema)
    return remembered(rows, settings, evict, baseline, roles.changes())


def start_alerts(
    calls: DataFrame,
    roles: DataFrame,
    accounts: DataFrame,
    output: str,
    checkpoint: str,
    trigger: dict,
    period: int = HOUR,
    settings: Settings = Settings(),
    evict: bool = False,
    seed: BaselineStore | None = None,
    by_tick: bool = False,
) -> StreamingQuery:
    """Alerts to JSON lines: new actions of a micro-batch are grouped by role, as
    of its last tick, wherever the hour's edge falls.  They are written first and
    read back, so that the state is updated once however often they are used.  A
    repeated batch replaces its folders.

    ``by_tick`` keeps ticks apart, for history replayed in large micro-batches.
    """
    accounts = selected_accounts(accounts, settings)
    roles = roles_in_scope(roles, accounts)
    baseline = seed and seed.load(bucketed=False)
    stream = new_actions(
        role_action_stream(calls, roles, period, settings), settings, evict, baseline
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_alerts(batch, batch_id, roles, accounts, output, settings, by_tick)

    return _start(stream, write, checkpoint, trigger)


def start_alerts_following(
    calls: DataFrame,
    versions: InventoryVersions,
    output: str,
    checkpoint: str,
    trigger: dict,
    period: int = HOUR,
    settings: Settings = Settings(),
    evict: bool = False,
    seed: BaselineStore | None = None,
    by_tick: bool = False,
) -> StreamingQuery:
    """``start_alerts`` with inventories that change while the stream runs.

    Which roles count is decided by changes in the keyed state; names, policies and
    accounts come from the newest version when a micro-batch is first written, and a
    repeated micro-batch takes that version again.
    """
    stream = _remembered(calls, versions, period, settings, evict, seed)

    def write(batch: DataFrame, batch_id: int) -> None:
        version = versions.of_batch(checkpoint, batch_id)
        roles, accounts = versions.roles(version), versions.accounts(version)
        _write_alerts(batch, batch_id, roles, accounts, output, settings, by_tick)

    return _start(stream, write, checkpoint, trigger)


def _write_alerts(
    batch: DataFrame, batch_id: int, roles: DataFrame, accounts: DataFrame, output: str, settings: Settings, by_tick: bool
) -> None:
    new = written(batch, f"{output}/new_actions/batch={batch_id}")
    if not by_tick:
        last = new.agg(F.max("tick")).first()[0]
        new = new.select("role_id", "action").distinct().withColumn("tick", F.lit(last).cast("bigint"))
    concerned = alerts.roles_with_news(roles, new)
    records = alerts.alert_records(alerts.judged(new, concerned, settings), accounts)
    lines = alert_lines(records, F.timestamp_seconds("tick"), settings)
    write_lines(lines, f"{output}/alerts/batch={batch_id}")


def start_ticks(
    calls: DataFrame,
    roles: DataFrame,
    accounts: DataFrame,
    store: BaselineStore,
    output: str,
    checkpoint: str,
    trigger: dict,
    settings: Settings = Settings(),
    clock: Callable[[DataFrame], datetime] = lambda batch: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Every micro-batch is a tick of the batch job against the snapshot store.

    Prefer this where the state changes much per tick: it stays in the JVM and
    drops repeats before every shuffle.  The version of a batch follows from its
    number, so a batch repeated after a failure finds its version published and
    is passed over.
    """
    first = _first_version(store, output)

    def tick(batch: DataFrame, batch_id: int) -> None:
        version = first + batch_id
        if version + 1 in store.versions():
            return
        run_ts = clock(batch).replace(microsecond=0)
        folder = f"{output}/batch={batch_id}"
        run_tick(
            batch, roles, accounts, store, folder, run_ts, settings, version, windowed=False
        )

    return _start(calls, tick, checkpoint, trigger, mode="append")


def _first_version(store: BaselineStore, output: str) -> int:
    """The version the query first started from, kept for its restarts."""
    folder = f"{output}/first_version"
    kept = [int(name) for name in names_in(store.spark, folder) if name.isdigit()]
    if not kept:
        kept = [store.latest()]
        create_marker(store.spark, f"{folder}/{kept[0]}")
    return kept[0]


def latest_event(batch: DataFrame, period: int = HOUR) -> datetime:
    """A clock for history: the tick after the batch's last event."""
    last = batch.agg(F.max(tick_after(F.col("event_ts"), period))).first()[0]
    return datetime.fromtimestamp(last or 0, timezone.utc)


def _start(stream, write, checkpoint: str, trigger: dict, mode: str = "update"):
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
