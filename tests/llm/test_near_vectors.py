"""Links against brute force in double precision; the bound; odd rows."""

import numpy as np
import pytest

from rolehabit.llm import near_vectors as nv
from rolehabit.llm.common import QUERIES
from tests.oracle import connect, spark_rows, sql_rows


def brute(rows):
    """Rows (id, vector, label) with plain vectors: {row number: (id, links, component)}."""
    links = {i: set() for i in range(len(rows))}
    for i, (_, x, l) in enumerate(rows):
        for j, (_, y, m) in enumerate(rows):
            if i != j and l == m and len(x) == len(y):
                x1, y1 = np.array(x, float), np.array(y, float)
                if x1 @ y1 / np.linalg.norm(x1) / np.linalg.norm(y1) >= nv.THRESHOLD or x == y:
                    links[i].add(j)
    out, seen = [], {}
    for i in links:
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()] - group:
                    group.add(j)
                    todo.append(j)
            for j in group:
                seen[j] = min(rows[k][0] for k in group)
        out.append((rows[i][0], len(links[i]), seen[i], rows[i][0] == seen[i]))
    return sorted(out)


def test_query_agrees_with_sql(spark, sf_dir):
    names, rows = spark_rows(QUERIES["op7_near_vectors"](spark, sf_dir))
    from rolehabit.llm.common import SQL

    assert (names, rows) == sql_rows(connect(sf_dir), SQL["op7_near_vectors"])
    assert any(r[3] for r in rows)


@pytest.mark.parametrize("block", [5, 1000])
def test_small_blocks_and_near_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(nv, "BLOCK", block)
    monkeypatch.setattr(nv, "AT_ONCE", 7)
    draw = np.random.default_rng(2)
    rows = []
    for i in range(90):
        base = draw.normal(size=8) if i % 6 == 0 else base + draw.normal(size=8) * 0.35
        rows.append((i, [float(np.float32(v)) for v in base], i // 30))
    rows += [(100, rows[3][1], 0), (101, rows[3][1], 0), (102, rows[3][1], 1), (103, [2 * v for v in rows[3][1]], 0), (104, [1.0, 2.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, nv.near_vectors(frame).collect())) == brute(rows)


def test_bound_holds():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(200, 16)) * 10.0 ** draw.integers(-3, 3, (200, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    exact = x @ x.T
    coded = nv.quantised(x)
    for threshold in (-0.5, 0.2, 0.93, 0.999):
        assert nv.possible(coded, coded, threshold)[exact >= threshold].all()


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [1.0, nan], 0), (5, [inf, 1.0], 0), (6, [1.0, 1.0], None), (7, [1.0, 1.0], 0),
            (None, [1.0, 1.0], 0), (8, [], 0), (9, [1e-40, 1e-40], 0), (7, [1.0, 1.0], 0)]
    frame = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, label int, n_links int")
    got = sorted(map(tuple, nv.near_vectors(frame).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 8)]
    assert got == sorted([*alone, (7, 2, 7, True), (7, 2, 7, True), (9, 2, 7, False), (None, 0, None, True)], key=repr)
    assert nv.near_vectors(frame.limit(0)).collect() == []
