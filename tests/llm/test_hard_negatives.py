"""Mined negatives against brute force in whole numbers; the bounds; odd rows."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rolehabit.llm import hard_negatives as hn
from rolehabit.llm.common import QUERIES, SQL
from tests.oracle import connect, spark_rows, sql_rows


def brute(rows, every):
    """(id, vector, label) rows of plain numbers."""
    found = []
    for i, x, label in {(i, tuple(math.floor(v * 256) for v in x), str(label)) for i, x, label in rows}:
        found.append((i, x, label))
    out = []
    for a in found:
        if a[0] % every:
            continue
        scored = [(b, sum(p * q for p, q in zip(a[1], b[1]))) for b in found if b != a and len(a[1]) == len(b[1])]
        same = sorted((-s, b[0]) for b, s in scored if b[2] == a[2])[:5]
        for minus, positive in same:
            close = sorted((-s, b[0]) for b, s in scored if b[2] != a[2] and 80 * -minus <= 100 * s <= 100 * -minus)[:5]
            out += [(a[0], positive, n + 1, b, -minus, -s) for n, (s, b) in enumerate(close)]
    return sorted(out)


def clustered(seed, count, size):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, size))
    rows = []
    for i in range(count):
        x = centres[i % 6] * draw.uniform(0.5, 2) + draw.normal(size=size) * draw.choice([0.1, 0.6])
        rows.append((i, [float(np.float32(v)) for v in x], int(draw.integers(3))))
    return rows


@pytest.mark.parametrize("block, batch", [(64, 2), (1 << 20, 128)])
def test_agrees_with_brute_force(spark, monkeypatch, block, batch):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "BATCH", batch)
    rows = clustered(1, 240, 12) + clustered(2, 30, 5)
    rows += [rows[10], rows[10], (10, rows[4][1], 1), (20, rows[20][1], 2), (500, [0.0] * 12, 1), (300, [0.001] * 12, 0)]
    frame = spark.createDataFrame([(*r, "x", 1.5) for r in rows], "vec_id long, embedding array<float>, label int, node string, score double")
    got = sorted(map(tuple, hn.hard_negatives(frame, F.col("id") % 10 == 0).collect()))
    assert got == brute(rows, 10) and len(got) > 100


def test_large_codes_are_exact(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in draw.normal(size=3) * 10.0 ** draw.integers(0, 7)], i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, hn.hard_negatives(frame, F.col("id") % 5 == 0).collect())) == brute(rows, 5)


def vectors(codes, references):
    norm, angles = hn.angles_to(codes, references)
    return hn.Vectors(pa.table({
        "node": np.arange(len(codes)), "id": np.arange(len(codes)), "label": ["0"] * len(codes), "norm": norm,
        "codes": pa.array(list(codes)), "angles": pa.array(list(angles), pa.list_(pa.float32())),
    }))


@pytest.mark.parametrize("many", [1, 5, 23, 24])
def test_bounds_hold_and_narrow(many):
    draw = np.random.default_rng(3)
    codes = np.floor(draw.normal(size=(150, 24)) * 10.0 ** draw.integers(0, 4, (150, 1)))
    codes[7] = 0
    codes[8] = codes[9] * 2
    codes[11] = [1000, *[0] * 23]
    references = np.linalg.qr(draw.normal(size=(24, 24)))[0][:, :many]
    for directions in (references, np.eye(24)[:, :many]):
        rows = vectors(codes, directions)
        least, greatest = rows.bounds(rows)
        exact = codes @ codes.T
        assert (least <= exact).all() and (exact <= greatest).all()
    if many == 1:  # the plain triangle of angles
        norm, angles = hn.angles_to(codes, references)
        sums = np.cos(angles + angles.T.astype(float)) * np.outer(norm, norm)
        narrow = hn.Vectors.bounds(vectors(codes, references), vectors(codes, references))
        assert np.allclose(narrow[0], sums, atol=1e-4 * np.outer(norm, norm).max())
    if many == 24:
        assert (greatest - least <= 1e-3 * np.outer(rows.norm, rows.norm) + 1e-9).all()


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.9, 0.9], 2), (3, [1.0, 0.9], 2), (4, [1.0], 1)]
    odd = [(5, None, 1), (6, [1.0, None], 2), (7, [nan, 1.0], 2), (8, [inf, 1.0], 1), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 2), (10, [], 1), (20, [], 2)]
    frame = spark.createDataFrame(good + odd, "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, hn.hard_negatives(frame, F.col("id") % 10 == 0).collect())) == brute(good, 10) != []
    assert hn.hard_negatives(frame.limit(0), F.col("id") % 10 == 0).collect() == []


def test_query_agrees_with_sql(spark, sf_dir):
    assert spark_rows(QUERIES["op12_hard_negatives"](spark, sf_dir)) == sql_rows(connect(sf_dir), SQL["op12_hard_negatives"])
