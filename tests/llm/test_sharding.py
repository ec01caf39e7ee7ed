"""Shards against a plain ranking in Python, the mixture in every shard, odd rows, whole rows."""

import hashlib
import zlib
from collections import Counter

import pytest

from rolehabit.llm import sharding as sh
from rolehabit.llm.common import QUERIES, SQL
from tests.oracle import connect, spark_rows, sql_rows


def number(text, bits):
    return int(hashlib.md5(text.encode()).hexdigest()[: bits // 4], 16)


def brute(rows, shards):
    """(key, source, text) rows: sorted (key, source, size, crc, shard, slot)."""
    strata = {}
    for key, source, text in rows:
        data = (text or "").encode()
        size, crc = len(data) + 1, zlib.crc32(data)
        parts = [str(sh.SEED), *([str(key)] if key is not None else []), str(crc), str(size)]
        order = (number("/".join(parts), sh.ORDER_BITS), key is not None, key or 0, crc, size)
        strata.setdefault("" if source is None else "s" + source, []).append((order, key, source, size, crc))
    placed = []
    for stratum, found in strata.items():
        phase = number(f"{sh.SEED}/phase/{stratum}", sh.PHASE_BITS) / float(1 << sh.PHASE_BITS)
        for rank, row in enumerate(sorted(found, key=lambda f: f[0])):
            placed.append(((rank + phase) / len(found), stratum, row[0], rank, row))
    placed.sort(key=lambda p: p[:4])
    n, out, slots = len(placed), [], Counter()
    for position, (*_, row) in enumerate(placed):
        shard = position * shards // n
        out.append((*row[1:], shard, slots[shard]))
        slots[shard] += 1
    return sorted(out, key=repr)


def made(count):
    names = ["hot"] * 6 + ["b", "b", "c", None, ""]
    rows = [(i, names[i % len(names)], f"text {i % 37} é" * (i % 5)) for i in range(count)]
    return rows + [(None, "hot", None), (None, "hot", None), (None, None, "x"), (3, "hot", "z")] + [(7, "b", "copy")] * 90


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_agrees_with_plain_ranking(spark, monkeypatch, shards):
    rows = made(300)
    frame = spark.createDataFrame([(*r, 5, "clash") for r in rows], "doc_id long, source string, text string, shard int, rank string")
    got = sorted(map(tuple, sh.assigned(frame, shards=shards).select("doc_id", "source", "size", "text_crc32", "shard", "slot").collect()), key=repr)
    assert got == brute(rows, shards)
    # the number of buckets changes nothing
    monkeypatch.setattr(sh, "LEAST_BITS", 3)
    again = sh.assigned(frame, shards=shards).select("doc_id", "source", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, again), key=repr) == got


def test_every_shard_has_the_mixture(spark):
    rows = [(i, f"s{min(i % 12, 7)}", "t") for i in range(4000)] + [(i, f"host {i}", "u") for i in range(4000, 4400)]
    got = sh.assigned(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    counts = Counter(r["shard"] for r in got)
    assert set(counts.values()) == {550}
    sources = Counter(r["source"] for r in got)
    for (shard, source), n in Counter((r["shard"], r["source"]) for r in got).items():
        assert abs(n - sources[source] / 8) <= 3 + 8 ** 0.5, (shard, source)
    hosts = Counter(r["shard"] for r in got if r["source"].startswith("host"))
    assert min(hosts.values()) > 25  # sources of one row are spread as well


def test_whole_rows_and_files(spark, tmp_path):
    rows = [(i % 50, "a" if i % 3 else None, f"t{i % 20}", i % 2) for i in range(200)] + [(1, "a", "same", 1)] * 40
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, slot int")
    frame = frame.selectExpr("*", "map('k', doc_id) AS m", "text AS row", "text AS digest")
    got = sh.sharded(frame, shards=6)
    assert got.columns == ["doc_id", "source", "text", "m", "row", "digest", "shard", "slot"]
    assert Counter((r.doc_id, r.source, r.text) for r in got.collect()) == Counter(r[:3] for r in rows)
    by_shard = {}
    for r in got.collect():
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert {k: sorted(v) for k, v in by_shard.items()} == {k: list(range(40)) for k in range(6)}
    sh.write_shards(frame, str(tmp_path / "out"), shards=6)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_empty_and_few(spark):
    frame = spark.createDataFrame([(1, "a", "x"), (2, None, None)], "doc_id long, source string, text string")
    assert sh.assigned(frame.limit(0)).collect() == [] and sh.sharded(frame.limit(0)).collect() == []
    assert [r.slot for r in sh.assigned(frame).collect()] == [0, 0]


def test_query_agrees_with_sql(spark, sf_dir):
    assert spark_rows(QUERIES["op11_sharding"](spark, sf_dir)) == sql_rows(connect(sf_dir), SQL["op11_sharding"])
