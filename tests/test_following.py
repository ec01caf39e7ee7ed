"""Streams that follow the inventory, state per role, windows with a bound on lateness, counters."""

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rolehabit.settings import Settings
from rolehabit.sources.versions import InventoryVersions
from rolehabit.streaming import jobs, late
from rolehabit.streaming.progress import ProgressLog
from tests.samples import CALL, accounts, calls, role, roles


def put(spark, folder, name, rows):
    calls(spark, rows).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder):
    return spark.readStream.schema(CALL).parquet(f"{folder}/*")


def found(spark, out):
    return sorted((r.role_id, r.action, r.tick, int(r.batch)) for r in spark.read.parquet(out).collect())


def test_role_added_while_the_stream_runs(spark, tmp_path):
    """One running query: the role's earlier calls are neither learned nor reported."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    versions = InventoryVersions(spark, str(tmp_path / "inventory"))
    with pytest.raises(ValueError):
        versions.changes()
    versions.publish(roles(spark, role("R1")), accounts(spark))
    put(spark, source, "a", [(1, "R1", "a"), (1, "R2", "a")])
    query = jobs.start_new_actions_by_role(
        stream(spark, source), versions, out, str(tmp_path / "checkpoint"), {"processingTime": "200 milliseconds"}, 1
    )
    try:
        query.processAllAvailable()
        versions.publish(roles(spark, role("R1"), role("R2")), accounts(spark))
        query.processAllAvailable()
        put(spark, source, "b", [(5, "R1", "a"), (5, "R2", "a"), (5, "R2", "b")])
        query.processAllAvailable()
        versions.publish(roles(spark, role("R2")), accounts(spark))  # R1 is gone
        query.processAllAvailable()
        put(spark, source, "c", [(9, "R1", "c"), (9, "R2", "c")])
        query.processAllAvailable()
    finally:
        query.stop()
    got = [(r, a, t) for r, a, t, _ in found(spark, out)]
    assert got == [("R1", "svc:a", 2), ("R2", "svc:a", 6), ("R2", "svc:b", 6), ("R2", "svc:c", 10)]


def test_alerts_name_roles_of_the_newest_version(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", str(tmp_path / "checkpoint")
    versions = InventoryVersions(spark, str(tmp_path / "inventory"))

    def run(name, rows):
        put(spark, source, name, rows)
        jobs.start_alerts_following(
            stream(spark, source), versions, str(out), checkpoint, jobs.until_caught_up(), settings=Settings(role_grace=0)
        ).awaitTermination()

    versions.publish(roles(spark, role("R1")), accounts(spark))
    run("a", [(1, "R1", "a"), (1, "R2", "a")])
    versions.publish(roles(spark, role("R1"), role("R2")), accounts(spark))
    run("b", [(2, "R2", "b")])
    events = [json.loads(json.loads(r.value)["event"]) for r in spark.read.text(f"{out}/alerts").collect()]
    assert sorted((e["principalId"], e["role_actions"]) for e in events) == [("R1", ["svc:a"]), ("R2", ["svc:b"])]
    # a repeated micro-batch takes the version it took before
    assert versions.of_batch(checkpoint, 0) == 1 and versions.of_batch(checkpoint, 1) == 2


def test_versions_and_changes(spark, tmp_path):
    versions = InventoryVersions(spark, str(tmp_path))
    assert versions.latest() == 0

    def changed(version):
        rows = spark.read.parquet(f"{tmp_path}/changes/v{version:08d}").collect()
        return sorted((r.role_id, r.present, r.version) for r in rows)

    assert versions.publish(roles(spark, role("R1"), role("R2")), accounts(spark)) == 1
    assert changed(1) == [("R1", True, 1), ("R2", True, 1)]
    versions.publish(roles(spark, role("R1"), role("R2")), accounts(spark))
    assert changed(2) == []
    versions.publish(roles(spark, role("R2"), role("R3")), accounts(spark))
    assert changed(3) == [("R1", False, 3), ("R3", True, 3)]
    # the role that went is still known by name
    assert sorted((r.role_id, r.present) for r in versions.roles(3).collect()) == [("R1", False), ("R2", True), ("R3", True)]
    # an attempt that did not finish is no version, and the next one replaces it
    (tmp_path / "changes" / "v00000003" / "_SUCCESS").unlink()
    assert versions.latest() == 2
    assert versions.publish(roles(spark, role("R1")), accounts(spark)) == 3
    assert changed(3) == [("R2", False, 3)]


def test_timer_drops_untouched_actions(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    start = int(time.time())

    def run(name, names):
        put(spark, source, name, [(int(time.time()), "R1", a) for a in names])
        query = jobs.start_new_actions_by_role(
            stream(spark, source), roles(spark, role("R1")), out, str(tmp_path / "checkpoint"),
            jobs.until_caught_up(), 1, Settings(ttl=9), evict=True,
        )
        query.awaitTermination()
        return query.recentProgress[-1].stateOperators[0]

    run("a", ["x", "y"])
    time.sleep(max(0, start + 5 - time.time()))
    run("b", ["x"])
    time.sleep(max(0, start + 13 - time.time()))
    # y has lapsed, x was refreshed; the timer has run, so y is new by the state alone
    run("c", ["x", "y"])
    assert [(a, b) for _, a, _, b in found(spark, out)] == [("svc:x", 0), ("svc:y", 0), ("svc:y", 2)]


def test_state_per_role_starts_from_a_baseline(spark, tmp_path):
    class Seed:
        def load(self, bucketed):
            return spark.createDataFrame([("R1", "svc:a", 110), ("R1", "svc:b", 101), ("R9", "svc:z", 1)], "role_id string, action string, ttl long")

    put(spark, tmp_path / "in", "a", [(50, "R1", "a"), (50, "R1", "b"), (50, "R1", "c"), (150, "R1", "c"), (151, "R1", "c"), (300, "R1", "c")])
    jobs.start_new_actions_by_role(
        stream(spark, tmp_path / "in"), roles(spark, role("R1")), str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        jobs.until_caught_up(), 1, Settings(ttl=100), seed=Seed(),
    ).awaitTermination()
    got = [(a, t) for _, a, t, _ in found(spark, str(tmp_path / "out"))]
    assert got == [("svc:c", 51), ("svc:c", 301)]  # a was seen at 10, b at 1: both known at 51


EVENT = "event_id long, event_ts timestamp, principal_id string, event_source string, event_name string, identity_type string"


def test_windows_close_once_and_late_events_are_counted(spark, tmp_path):
    first = datetime(2024, 1, 1)

    def event(number, hour, name="a", who="R1"):
        return (number, first + timedelta(hours=hour), who, "svc", name, "AssumedRole")

    batches = [
        [event(1, 1), event(2, 10), event(None, 3.5), event(None, 3.5)],
        [event(3, 2, "b"), event(4, 8.5), event(2, 10), event(5, 20)],  # 2 comes again
        [event(6, 7.9), event(7, 8.1, "c"), event(8, 30), event(9, 9, who="other")],  # 6 is too late
        [event(10, 60)],
    ]
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        for rows in batches:
            spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            events = spark.readStream.schema(EVENT).parquet(str(tmp_path / "in"))
            query = late.start_role_windows(
                events, roles(spark, role("R1")), str(tmp_path / "out"), str(tmp_path / "checkpoint"), jobs.until_caught_up(), 2 * 3600
            )
            log.wait(query)
        counters = sorted((r.batch_id, r.input_rows, r.late_rows) for r in log.rows().collect())
    assert counters == [(0, 4, 0), (1, 4, 0), (2, 4, 1), (3, 1, 0)]
    rows = spark.read.parquet(str(tmp_path / "out")).withColumn("hour", (F.col("tick") - 1704067200) / 3600)
    got = sorted((r.hour, r.n_calls, r.role_actions) for r in rows.collect())
    assert got == [(2, 1, ["svc:a"]), (3, 1, ["svc:b"]), (4, 2, ["svc:a"]), (9, 2, ["svc:a", "svc:c"]), (11, 1, ["svc:a"]), (21, 1, ["svc:a"])]


def test_observed_metrics_are_kept(spark, tmp_path):
    put(spark, tmp_path / "in", "a", [(1, "R1", "a"), (2, "R1", "b")])
    counted = stream(spark, tmp_path / "in").observe("calls", F.count("*").alias("n"), F.max("event_name").alias("last"))
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        query = counted.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        log.wait(query)
        (row,) = log.rows().collect()
    assert (row.input_rows, row.observed) == (2, {"calls.n": "2", "calls.last": "b"})
