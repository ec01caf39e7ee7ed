"""Stream pieces that need no history: ingest, alert lines, eviction, the combiner."""

import json
import time
from types import SimpleNamespace

import pyarrow as pa
from pyspark.sql import Row

from rolehabit.settings import Settings
from rolehabit.sources import audit
from rolehabit.streaming import jobs
from rolehabit.streaming import stateful
from rolehabit.streaming.stateful import LastSeen, without_repeats
from tests.samples import CALL, FIRST, SECOND, accounts, calls, put_audit_file, role, roles


def test_ingest_takes_each_file_once(spark, tmp_path):
    base, table = tmp_path / "logs", str(tmp_path / "table")

    def run():
        files = audit.stream_audit_files(spark, str(base))
        jobs.start_ingest(
            files, table, str(tmp_path / "checkpoint"), jobs.until_caught_up()
        ).awaitTermination()

    put_audit_file(base, [FIRST, SECOND])
    run()
    put_audit_file(base, [SECOND], name="late.json")
    run()
    run()
    rows = audit.read_audit_table(spark, table).collect()
    assert sorted(r.eventName for r in rows) == ["GetObject", "ListRoles", "ListRoles"]
    assert {r.account for r in rows} == {"1"}


def test_alert_lines_of_a_stream(spark, tmp_path):
    calls(spark, [(10, "R1", "a"), (20, "R1", "b"), (30, "R2", "a")]).coalesce(1).write.parquet(
        str(tmp_path / "in")
    )
    jobs.start_alerts(
        spark.readStream.schema(CALL).parquet(str(tmp_path / "in")),
        roles(spark, role("R1"), role("R2", path="aws-service-role/")),
        accounts(spark),
        str(tmp_path / "out"),
        str(tmp_path / "checkpoint"),
        jobs.until_caught_up(),
        settings=Settings(role_grace=0),
    ).awaitTermination()
    lines = spark.read.text(str(tmp_path / "out/alerts")).collect()
    (line,) = [json.loads(r.value) for r in lines]
    assert line["time"] == 3600
    assert json.loads(line["event"])["role_actions"] == ["svc:a", "svc:b"]


def test_untouched_keys_are_evicted(spark, tmp_path):
    """With eviction, state left alone for ``ttl`` of wall time is gone."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    settings = Settings(ttl=8)

    def run(name, batch):
        calls(spark, [(1, "R1", a) for a in batch]).coalesce(1).write.parquet(f"{source}/{name}")
        jobs.start_new_actions(
            spark.readStream.schema(CALL).parquet(f"{source}/*"),
            roles(spark, role("R1")),
            out,
            str(tmp_path / "checkpoint"),
            jobs.until_caught_up(),
            1,
            settings,
            evict=True,
        ).awaitTermination()

    run("a", ["x", "y"])
    time.sleep(10)
    run("b", ["x"])
    got = sorted((r.action, r.batch) for r in spark.read.parquet(out).collect())
    assert got == [("svc:x", "0"), ("svc:x", "1"), ("svc:y", "0")]


def test_combiner_flushes_and_keeps_every_key(monkeypatch):
    monkeypatch.setattr("rolehabit.streaming.stateful.FLUSH_ROWS", 3)
    names = ["role_id", "action", "tick"]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(r), pa.array(a), pa.array(t)], names)
        for r, a, t in [
            (["r", "r", "s"], ["x", "x", "x"], [1, 1, 1]),
            (["r", "t"], ["x", "x"], [1, 2]),
            (["r", "u"], ["x", "x"], [1, 1]),
        ]
    ]
    rows = [tuple(row.values()) for b in without_repeats(iter(batches)) for row in b.to_pylist()]
    assert set(rows) == {("r", "x", 1), ("s", "x", 1), ("t", "x", 2), ("u", "x", 1)}
    assert len(rows) == 5  # the three held rows went out before the last batch


def run_alerts(spark, tmp_path, batches, name, **options):
    """Alerts of calls given file by file: (severity, number of actions)."""
    source = tmp_path / name
    for n, rows in enumerate(batches):
        calls(spark, rows).coalesce(1).write.parquet(f"{source}/{n}")
    reader = spark.readStream.schema(CALL)
    for key, value in options.items():
        reader = reader.option(key, value)
    jobs.start_alerts(
        reader.parquet(f"{source}/*"),
        roles(spark, role("R1")),
        accounts(spark),
        f"{tmp_path}/{name}-out",
        f"{tmp_path}/{name}-checkpoint",
        jobs.until_caught_up(),
        settings=Settings(role_grace=0),
    ).awaitTermination()
    events = [json.loads(json.loads(r.value)["event"]) for r in spark.read.text(f"{tmp_path}/{name}-out/alerts").collect()]
    return [(e["severity"], len(e["role_actions"])) for e in events]


def test_alerts_do_not_depend_on_files_or_the_hours_edge(spark, tmp_path):
    early, late = [(3590, "R1", a) for a in "abc"], [(3595, "R1", a) for a in "def"]
    assert run_alerts(spark, tmp_path, [early, late], "files") == [("High", 6)]
    edge = [(3600, "R1", a) for a in "def"]
    assert run_alerts(spark, tmp_path, [early + edge], "edge") == [("High", 6)]


def test_combiner_groups_few_times(monkeypatch):
    """Not once a batch: that regroups all that is held each time."""
    calls_made = []
    plain = stateful._distinct
    monkeypatch.setattr(stateful, "_distinct", lambda batches: calls_made.append(1) or plain(batches))
    monkeypatch.setattr(stateful, "FLUSH_ROWS", 100)
    batch = pa.RecordBatch.from_pydict({"role_id": ["r"] * 10, "action": list("abcdefghij"), "tick": [1] * 10})
    assert sum(b.num_rows for b in without_repeats(iter([batch] * 100))) == 10
    assert len(calls_made) <= 13


class Store:
    """Stands for the state store of one key: its list, and the calls made to it."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def getListState(self, *_, **__):
        return self

    def get(self):
        self.calls += 1
        return iter(self.rows)

    def put(self, rows):
        self.calls += 1
        self.rows = rows


def seen(store, *rows, ttl=5, now=None):
    """What a key's rows (action, tick) give rise to."""
    processor = LastSeen(ttl, evict=now is not None)
    processor.init(store)
    given = [Row(role_id="R", action=a, tick=t) for a, t in rows]
    timer = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
    return [(r.action, r.tick) for r in processor.handleInputRows(("R", 0), iter(given), timer)]


def test_a_keys_actions_are_read_and_written_at_once():
    store = Store()
    assert seen(store, ("b", 1), ("a", 9), ("a", 1), ("a", 4), ("b", 7), ("a", 1)) == [("a", 1), ("b", 1), ("b", 7)]
    assert store.calls == 2
    assert seen(store, ("a", 14), ("a", 3), ("b", 13), ("c", None), ("c", 2)) == [("b", 13), ("c", 2)]
    assert seen(store, ("a", None), ("d", None)) == [("d", None)]


def test_an_action_is_forgotten_by_itself():
    """Though another one of its key is still touched."""
    store = Store()
    assert seen(store, ("a", 1), ("b", 1), now=1_000) == [("a", 1), ("b", 1)]
    assert seen(store, ("a", 1), now=5_000) == []
    assert seen(store, ("a", 1), ("b", 1), now=7_000) == [("b", 1)]
