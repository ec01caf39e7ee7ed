"""Recall against brute force, scores in double precision, odd rows."""

import numpy as np

from rolehabit.llm import forest
from rolehabit.llm.common import QUERIES


def brute(rows, every=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in ids[ids % every == 0]:
        score = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][: forest.NEAREST]
        out[int(q)] = [(int(ids[i]), score[i]) for i in order]
    return out


def compare(got, wanted):
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by.keys() == wanted.keys()
    hits = total = 0
    for q, best in wanted.items():
        assert len(by[q]) == len(best)
        assert by[q] == sorted(by[q], key=lambda s: (-s[1], s[0]))
        hits += len({i for i, _ in by[q]} & {i for i, _ in best})
        total += len(best)
    return hits / total


def test_recall_of_the_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert compare(QUERIES["op4_forest"](spark, sf_dir).collect(), brute(rows)) > 0.9


def test_prefixes_chunks_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(forest, "CHUNK", 50)
    monkeypatch.setattr(forest, "QUERY_CHUNK", 5)
    draw = np.random.default_rng(4)
    x = draw.normal(size=(1500, 8)) * draw.uniform(0.2, 3, (1500, 1))
    x[300:400] = x[7]  # copies
    rows = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    wanted = brute(rows)
    for enough, least in ((10_000, 1.0), (200, 0.8)):
        monkeypatch.setattr(forest, "ENOUGH", enough)
        got = forest.nearest(frame).collect()
        assert compare(got, wanted) >= least
        exact = {(q, i): s for q, best in wanted.items() for i, s in best}
        assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-9 for r in got if (r.query_id, r.vec_id) in exact)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (40, None),
            (6, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = sorted(map(tuple, forest.nearest(frame).collect()))
    assert got == [(0, 1, 1, 1.0), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert forest.nearest(frame.limit(0)).collect() == []


def test_recall_on_both_sides_of_a_level_switch(spark, monkeypatch):
    # a query meets itself in 48 trees; beside it 75 are met at one letter of 1,000 near-uniform vectors, at two of 4,000
    monkeypatch.setattr(forest, "ENOUGH", 75)
    found = {}

    def stored(frame, name, *by):
        table = forest_stored(frame, name, *by)
        if name in ("levels", "stopped"):
            found.setdefault(name, []).append(table.collect())
        return table

    forest_stored = forest.stored
    monkeypatch.setattr(forest, "stored", stored)
    for n, start in ((1000, 1), (4000, 2)):
        found.clear()
        x = np.random.default_rng(n).normal(size=(n, 32))
        rows = [(i, v.tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))]
        got = forest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
        levels = [r.level for r in found["levels"][0]]
        assert np.median(levels) == start
        # most queries end below the root
        assert sum(map(len, found["stopped"])) > 0.5 * len(levels)
        assert compare(got, brute(rows)) >= 0.9
