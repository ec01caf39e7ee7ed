"""Lookups, merge, expiry and the snapshot store."""

import random

import pytest

from rolehabit.operators import novelty
from rolehabit.plans.replay import occurrences, replay
from rolehabit.registry.base import fx_calls, fx_roles
from rolehabit.schemas import BASELINE, OCCURRENCE
from rolehabit.sources.baseline import BaselineStore, live
from tests.samples import plan_of, role, roles

NOW = 1_000_000
TTL = 100


@pytest.fixture
def stored(spark):
    rows = [("r", "live", NOW + 5), ("r", "edge", NOW), ("r", "expired", NOW - 1)]
    return spark.createDataFrame(rows, BASELINE)


@pytest.fixture
def seen(spark):
    rows = [("r", name, NOW) for name in ("live", "edge", "expired", "never")]
    return spark.createDataFrame(rows, OCCURRENCE)


def pairs(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())


def test_a_row_is_good_in_its_last_second(spark, stored, seen):
    assert pairs(live(stored, NOW), "action") == [("edge",), ("live",)]
    assert pairs(novelty.new_actions(seen, stored, NOW), "action") == [("expired",), ("never",)]
    assert pairs(novelty.known_actions(seen, stored, NOW), "action") == [("edge",), ("live",)]
    decided = pairs(novelty.decide(seen, stored, NOW), "action", "is_new")
    assert decided == [("edge", False), ("expired", True), ("live", False), ("never", True)]


def test_merge_refreshes_inserts_keeps_and_drops(spark, stored):
    seen = spark.createDataFrame([("r", "edge", NOW), ("r", "never", NOW)], OCCURRENCE)
    merged = pairs(novelty.merge(stored, seen, NOW, TTL), "action", "ttl")
    assert merged == [("edge", NOW + TTL), ("live", NOW + 5), ("never", NOW + TTL)]


def test_store_versions(spark, tmp_path, stored):
    root = str(tmp_path / "store")
    store = BaselineStore(spark, root, buckets=3)
    assert store.latest() == 0 and store.load().count() == 0
    store.write(stored, 1)
    assert store.latest() == 0  # written, not published
    store.write(stored.where("action <> 'live'"), 1)  # a repeated run replaces it
    store.publish(1, NOW)
    assert pairs(store.load(), "action") == [("edge",), ("expired",)]
    with pytest.raises(Exception, match="already exists"):
        store.publish(1, NOW)
    for version in (2, 3, 4):
        store.write(stored, version)
        store.publish(version, NOW + version)
    store.expire(keep=2)
    assert store.versions() == [3, 4] and store.runs() == {NOW: 1, **{NOW + i: i for i in (2, 3, 4)}}
    again = BaselineStore(spark, root, buckets=99)
    assert again.buckets == 3 and again.load().count() == 3
    spark.sql(f"DROP TABLE {again._table(4)}")  # as in a session that did not write it
    assert again.load().count() == 3


def test_tick_does_not_shuffle_the_state(spark, tmp_path, stored, seen):
    store = BaselineStore(spark, str(tmp_path / "store"), buckets=8)
    store.write(stored, 1)
    store.publish(1, NOW)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (
            novelty.decide(seen, store.load(), NOW),
            novelty.merge(store.load(), seen, NOW, TTL),
        ):
            plan = plan_of(frame).split("== Physical Plan ==")[1]
            assert "Bucketed: true" in plan
            assert plan.count("Exchange hashpartitioning") == 1  # the tick's rows only
        store.write(novelty.merge(store.load(), seen, NOW, TTL), 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    files = [p for p in (tmp_path / "store/snapshots/v00000002").glob("part-*.parquet")]
    assert 0 < len(files) <= 8  # each task wrote its own bucket


def simulate(rows, ttl):
    """Sequential lookups and refreshes, the rule itself."""
    expiry, new = {}, []
    for key, tick in sorted(rows, key=lambda r: r[1]):
        if key not in expiry or expiry[key] < tick:
            new.append((key, tick))
        expiry[key] = tick + ttl
    return sorted(new)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_forms_of_the_rule(spark, seed):
    rng = random.Random(seed)
    ttl = rng.choice([50, 100, 137])
    rows = {
        (key, rng.choice([rng.randrange(3000), 100 * rng.randrange(30)]))
        for key in ["a", "b", "c", *["hot"] * 12]
        for _ in range(rng.randrange(5, 25))
    }
    frame = spark.createDataFrame([(k, "x", t) for k, t in rows], OCCURRENCE)
    wanted = simulate(rows, ttl)
    for result in (
        novelty.first_or_lapsed(frame, ttl),
        novelty.first_or_lapsed_in_blocks(frame.union(frame), ttl, 150),
        novelty.first_or_lapsed_in_blocks(frame, ttl, 1000),
        novelty.sessions(frame, ttl),
    ):
        assert pairs(result, "role_id", "tick") == wanted
    last = {}
    for key, tick in rows:
        if tick <= 2000:
            last[key] = max(last.get(key, tick), tick)
    left = sorted((k, t + ttl) for k, t in last.items() if t + ttl >= 2000)
    assert pairs(novelty.baseline_as_of(frame, 2000, ttl), "role_id", "ttl") == left


def test_hot_role_is_split_inside_the_join(spark):
    """Two thirds of all rows by one role, no broadcast: tasks of the join share it."""
    spread = spark.range(0, 120_000, 1, 8).selectExpr(
        "timestamp_seconds(id * 60) AS event_ts",
        "'svc' AS event_source",
        "concat('call', pmod(xxhash64(id), 97)) AS event_name",
        "if(id % 3 = 0, concat('R', id % 50), 'hot') AS principal_id",
        "'AssumedRole' AS identity_type",
    )
    inventory = roles(spark, role("hot"), *[role(f"R{n}") for n in range(50)])
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        frame = occurrences(spread, inventory, 60)
        assert frame.count() == 120_000
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan


def test_large_inventory_does_not_gather_a_hot_role(spark, sf_dir):
    """Without a broadcast the window must not inherit the join's placement by role."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(replay(fx_calls(spark, sf_dir), fx_roles(spark, sf_dir)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    physical = plan.split("== Physical Plan ==")[1]
    window, rest = physical.split("SortMergeJoin", 1)
    assert "hashpartitioning(role_id" in window and "action" in window.split("Exchange")[1]
    assert "HashAggregate" in rest  # distinct before the join, not after it
