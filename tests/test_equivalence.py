"""Batch ticks, replay and streams answer alike."""

import json
import random
from datetime import timedelta

import pytest

from rolehabit.functions.moments import EPOCH
from rolehabit.plans.replay import replay, replay_alerts, warm_up
from rolehabit.plans.tick import run_tick
from rolehabit.settings import Settings
from rolehabit.sources.baseline import BaselineStore
from rolehabit.streaming import jobs
from tests.samples import CALL, accounts, calls, role, roles
from tests.test_baseline import simulate

PERIOD = 3600
TICKS = 6
SETTINGS = Settings(ttl=2 * PERIOD, window=PERIOD, role_grace=0, ignored_actions=("svc:c",))


def at(tick):
    return EPOCH + timedelta(seconds=tick)


@pytest.fixture(scope="module")
def history(spark):
    """Random calls on six hours, a third of them by one role doing one thing."""
    rng = random.Random(7)
    rows = [
        (rng.randrange(TICKS * PERIOD), rng.choice(["R1", "R2", "R3", "ghost"]), rng.choice("abcdefg"))
        for _ in range(60)
    ]
    rows += [(rng.randrange(2 * PERIOD), "R1", "hot") for _ in range(30)]
    rows += [(n * PERIOD, "R2", "edge") for n in (0, 2, 5)]  # a gap of exactly ttl, and more
    return rows


@pytest.fixture(scope="module")
def inventory(spark):
    return roles(
        spark, role("R1"), role("R2", '{"AWS":"x"}'), role("R3", path="aws-service-role/")
    )


@pytest.fixture(scope="module")
def expected(history):
    rows = {
        ((who, f"svc:{what}"), (when // PERIOD + 1) * PERIOD)
        for when, who, what in history
        if who != "ghost"
    }
    return sorted((r, a, t) for (r, a), t in simulate(rows, SETTINGS.ttl))


def triples(frame):
    return sorted((r.role_id, r.action, r.tick) for r in frame.collect())


def events_in(spark, folder):
    return sorted(
        (json.loads(r.value)["time"], json.loads(r.value)["event"])
        for r in spark.read.text(folder).collect()
    )


def test_replay(spark, history, inventory, expected):
    assert triples(replay(calls(spark, history), inventory, PERIOD, SETTINGS)) == expected


def test_batch_ticks(spark, history, inventory, expected, tmp_path):
    store = BaselineStore(spark, str(tmp_path / "store"))
    frame, org = calls(spark, history), accounts(spark)
    out = str(tmp_path / "out")
    counters, sent = [], []
    for n in range(1, TICKS + 1):
        result = run_tick(frame, inventory, org, store, out, at(n * PERIOD), SETTINGS)
        counters.append(result.counters)
        sent += events_in(spark, result.alerts_folder)
    decided = spark.read.parquet(f"{out}/decisions")
    assert triples(decided.where("is_new")) == expected
    assert sum(c["new_actions"] for c in counters) == len(expected)
    ghosts = {(when // PERIOD, what) for when, who, what in history if who == "ghost"}
    assert sum(c["unknown_principal_actions"] for c in counters) == len(ghosts)
    assert store.latest() == TICKS

    whole = replay_alerts(frame, inventory, org, PERIOD, SETTINGS)
    wanted = sorted((r.tick, r.role_name, tuple(r.role_actions)) for r in whole.collect())
    got = [(t, json.loads(e)) for t, e in sent]
    assert sorted((t, e["role_name"], tuple(e["role_actions"])) for t, e in got) == wanted
    assert {e["role_name"] for _, e in got} == {"name-R1", "name-R2"}  # R3 is only learned
    assert store.load().where("role_id = 'R3'").count() > 0
    assert store.load().where("action = 'svc:c'").count() > 0  # ignored, but learned
    assert all("svc:c" not in e["role_actions"] for _, e in got)

    # repeating the last run from its own version gives its alerts again,
    # running it once more from the result gives none
    last = at(TICKS * PERIOD)
    again = BaselineStore(spark, str(tmp_path / "again"))
    again.write(store.load(TICKS - 1), 1)
    again.publish(1, 0)
    first = run_tick(frame, inventory, org, again, str(tmp_path / "o2"), last, SETTINGS)
    assert events_in(spark, first.alerts_folder) == [s for s in sent if s[0] == TICKS * PERIOD]
    retry = run_tick(frame, inventory, org, again, str(tmp_path / "o2"), last, SETTINGS)
    assert (retry.version, events_in(spark, retry.alerts_folder)) == (
        2,
        events_in(spark, first.alerts_folder),
    )
    second = run_tick(frame, inventory, org, again, str(tmp_path / "o2"), last, SETTINGS, 2)
    assert events_in(spark, second.alerts_folder) == []
    assert triples_of_state(again.load(2)) == triples_of_state(again.load(3))


def triples_of_state(frame):
    return sorted((r.role_id, r.action, r.ttl) for r in frame.collect())


def test_warm_up_equals_ticks_so_far(spark, history, inventory, expected, tmp_path):
    store = BaselineStore(spark, str(tmp_path / "store"))
    frame = calls(spark, history)
    warm_up(frame, inventory, store, at(3 * PERIOD), PERIOD, SETTINGS)
    out = str(tmp_path / "out")
    for n in range(4, TICKS + 1):
        run_tick(frame, inventory, accounts(spark), store, out, at(n * PERIOD), SETTINGS)
    decided = spark.read.parquet(f"{out}/decisions").where("is_new")
    assert triples(decided) == [row for row in expected if row[2] > 3 * PERIOD]


def hourly_files(spark, history, folder):
    """One file per hour, so that micro-batches come in order."""
    for n in range(TICKS):
        part = [row for row in history if row[0] // PERIOD == n]
        calls(spark, part).coalesce(1).write.parquet(f"{folder}/hour={n:02d}")


def call_stream(spark, folder):
    reader = spark.readStream.schema(CALL).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{folder}/*")


def test_keyed_state_stream(spark, history, inventory, expected, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        jobs.start_new_actions(
            call_stream(spark, source),
            inventory,
            out,
            str(tmp_path / "checkpoint"),
            jobs.until_caught_up(),
            PERIOD,
            SETTINGS,
        ).awaitTermination()

    calls(spark, [r for r in history if r[0] < 3 * PERIOD]).coalesce(1).write.parquet(f"{source}/a")
    run()
    first = [row for row in expected if row[2] <= 3 * PERIOD]
    assert triples(spark.read.parquet(out)) == first
    # a restart keeps the state
    calls(spark, [r for r in history if r[0] >= 3 * PERIOD]).coalesce(1).write.parquet(f"{source}/b")
    run()
    assert triples(spark.read.parquet(out)) == expected


def test_stream_seeded_from_a_snapshot(spark, history, inventory, expected, tmp_path):
    store = BaselineStore(spark, str(tmp_path / "store"))
    warm_up(calls(spark, history), inventory, store, at(3 * PERIOD), PERIOD, SETTINGS)
    later = [r for r in history if r[0] >= 3 * PERIOD]
    calls(spark, later).coalesce(1).write.parquet(str(tmp_path / "in/a"))
    out = str(tmp_path / "out")
    jobs.start_new_actions(
        call_stream(spark, tmp_path / "in"),
        inventory,
        out,
        str(tmp_path / "checkpoint"),
        jobs.until_caught_up(),
        PERIOD,
        SETTINGS,
        seed=store,
    ).awaitTermination()
    assert triples(spark.read.parquet(out)) == [r for r in expected if r[2] > 3 * PERIOD]


def test_micro_batches_as_ticks(spark, history, inventory, expected, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    store = BaselineStore(spark, str(tmp_path / "store"))

    def run(limit):
        jobs.start_ticks(
            call_stream(spark, source),
            inventory,
            accounts(spark),
            store,
            out,
            str(tmp_path / "checkpoint"),
            jobs.until_caught_up(),
            SETTINGS,
            clock=lambda batch: jobs.latest_event(batch, PERIOD),
        ).awaitTermination()
        assert store.latest() == limit

    for n in range(TICKS):
        part = [row for row in history if row[0] // PERIOD == n]
        calls(spark, part).coalesce(1).write.parquet(f"{source}/hour={n:02d}")
        if n == 1:
            run(2)
    run(TICKS)
    decided = spark.read.parquet(f"{out}/batch=*/decisions/run=*").where("is_new")
    assert triples(decided) == expected


def test_quiet_hours(spark, inventory, tmp_path):
    """Nothing seen, then everything expired, then something again."""
    store, out = BaselineStore(spark, str(tmp_path / "store")), str(tmp_path / "out")
    frame = calls(spark, [(10, "R1", "a"), (50 * PERIOD + 10, "R1", "a")])
    found = []
    for hour in (1, 2, 50, 51):
        result = run_tick(
            frame, inventory, accounts(spark), store, out, at(hour * PERIOD), SETTINGS
        )
        found.append((result.counters["new_actions"], store.load().count()))
    assert found == [(1, 1), (0, 1), (0, 0), (1, 1)]


def test_late_retry_of_an_older_run_changes_nothing(spark, history, inventory, tmp_path):
    store, out, frame = BaselineStore(spark, str(tmp_path / "store")), str(tmp_path / "out"), calls(spark, history)
    runs = [at(n * PERIOD) for n in (1, 2, 3)]
    first, *_ = [run_tick(frame, inventory, accounts(spark), store, out, t, SETTINGS) for t in runs]
    sent = events_in(spark, first.alerts_folder)
    assert sent
    store.expire(keep=1)
    late = run_tick(frame, inventory, accounts(spark), store, out, runs[0], SETTINGS)
    assert late.version == 1 and store.versions() == [3]
    assert events_in(spark, late.alerts_folder) == sent


def test_warm_up_refuses_a_filled_store(spark, history, inventory, tmp_path):
    store = BaselineStore(spark, str(tmp_path / "store"))
    warm_up(calls(spark, history), inventory, store, at(3 * PERIOD), PERIOD, SETTINGS)
    with pytest.raises(ValueError, match="already holds"):
        warm_up(calls(spark, history), inventory, store, at(PERIOD), PERIOD, SETTINGS)


def test_all_modes_keep_to_the_regions(spark, history, inventory, tmp_path):
    from dataclasses import replace

    from pyspark.sql import functions as F

    inside = replace(SETTINGS, regions=("us-east-1",))
    frame = calls(spark, history).withColumn("region", F.when(F.col("event_name") < "d", "us-east-1").otherwise("xx"))
    only = frame.where("region = 'us-east-1'")
    wanted = triples(replay(only, inventory, PERIOD, SETTINGS))
    assert wanted and triples(replay(frame, inventory, PERIOD, inside)) == wanted
    one, two = (BaselineStore(spark, str(tmp_path / n)) for n in "ab")
    warm_up(frame, inventory, one, at(3 * PERIOD), PERIOD, inside)
    warm_up(only, inventory, two, at(3 * PERIOD), PERIOD, SETTINGS)
    assert triples_of_state(one.load()) == triples_of_state(two.load())
    folder = str(tmp_path / "in")
    frame.coalesce(1).write.parquet(folder)
    jobs.start_new_actions(
        spark.readStream.schema(frame.schema).parquet(folder), inventory, str(tmp_path / "new"),
        str(tmp_path / "checkpoint"), jobs.until_caught_up(), PERIOD, inside,
    ).awaitTermination()
    assert triples(spark.read.parquet(str(tmp_path / "new"))) == wanted
