"""Targets by the stated rule, quotas by count, nearness of what is taken."""

import re
from collections import Counter, defaultdict

import pytest

from rolehabit.llm import mixing
from rolehabit.llm.common import QUERIES


def targets_by_rule(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, goal = set(), {}
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        goal = {s: 3.0 * sizes[s] if s in full else left * weight[s] / share for s in names}
        over = {s for s in names if s not in full and goal[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return goal
        full |= over


def check(rows, texts):
    sizes = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, (t, _) in texts.items()}
    by = Counter()
    for k, (_, s) in texts.items():
        by[s] += sizes[k]
    goal, taken, largest = targets_by_rule(by), Counter(), defaultdict(int)
    for r in rows:
        s = texts[r.doc_id][1]
        assert r.size == sizes[r.doc_id] and r.source_size == by[s]
        assert r.target == pytest.approx(goal[s], rel=1e-9)
        assert r.taken in {0, r.size, 2 * r.size, 3 * r.size}
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in by:
        assert abs(taken[s] - goal[s]) <= largest[s], s


def test_query(spark, sf_dir):
    texts = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op3_mixing"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    again = QUERIES["op3_mixing"](spark, sf_dir).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_small_blocks_odd_rows_and_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 40)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 200)
    texts = {i: ("w " * (i % 13), ["a", "b", "c", None, "\U0001f600", "￿"][min(i % 17, 5)]) for i in range(400)}
    texts |= {400: (None, "empty"), 401: ("x y\x1cz", "tiny"), 402: ("v " * 900, "b")}
    docs = spark.createDataFrame([(k, t, s, 5) for k, (t, s) in texts.items()], "doc_id long, text string, source string, size int")
    found = mixing.mix(docs)
    rows = found.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken", "shards").collect()
    check(rows, texts)
    shards = Counter(x for r in rows for x in r.shards)
    assert len(shards) > 8
    copies = mixing.mixed(docs, shard="shard")
    assert copies.columns == ["doc_id", "text", "source", "size", "shard"]
    assert Counter((r.doc_id, r.shard) for r in copies.collect()) == Counter((r.doc_id, x) for r in rows for x in r.shards)


def test_tree_gives_exact_quotas(spark):
    quotas = spark.createDataFrame([("sa", 50), ("sb", 7), ("", 1), ("sc", 0)], "__source string, draws long")
    rows = mixing.shard_quotas(quotas, 3).collect()
    by_shard, by_source = Counter(), Counter()
    for r in rows:
        by_shard[r.shard] += r.stop - r.start
        by_source[r["__source"]] += r.stop - r.start
    assert by_source == {"sa": 50, "sb": 7, "": 1}
    assert set(by_shard.values()) <= {7, 8} and len(by_shard) == 8
    places = sorted((r.start, r.stop) for r in rows if r["__source"] == "sa")
    assert places[0][0] == 0 and all(a[1] == b[0] for a, b in zip(places, places[1:], strict=False))


def test_repeated_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "s")] * 3 + [(None, "d", None)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert len(rows) == 4 and len({r.copies for r in rows if r.doc_id == 1}) == 1
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mixed(docs.limit(0)).collect() == []


def test_rows_without_a_key_are_drawn_by_their_texts(spark):
    rows = [(None, f"word {'more ' * (i % 7)}{i}", "aab"[i % 3]) for i in range(400)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 400
    for size in {r.source_size for r in got}:
        part = [r for r in got if r.source_size == size]
        assert abs(sum(r.size * r.copies for r in part) - part[0].target) <= 8
