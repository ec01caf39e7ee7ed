"""Held-out accuracy, whole texts, and odd rows."""

import zlib

import numpy as np

from rolehabit.llm import quality
from rolehabit.llm.common import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    rows = QUERIES["op5_quality"](spark, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    hits = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean(hits) > 0.85  # learned from some fifty rows at this size


def test_long_texts_are_scored_in_slices_as_a_whole(monkeypatch):
    net = quality.new_network()
    texts = [b"", b"short", bytes(range(32, 127)) * 200]
    whole = quality.scores(net, texts)
    logits = quality.forward(net, quality.chunked(texts[2]))[0]
    assert np.isclose(whole[2], 1 / (1 + np.exp(-logits.mean())), atol=1e-6)
    monkeypatch.setattr(quality, "AT_ONCE", 3)
    assert np.allclose(quality.scores(net, texts), whole, atol=1e-6)


def test_chunks_cover_every_byte():
    for size in (0, 1, quality.CHUNK, quality.CHUNK + 1, 5 * quality.STEP + 3):
        chunks = quality.chunked(b"x" * size)
        covered = np.zeros(len(chunks) * quality.STEP + quality.CHUNK, bool)
        for k, chunk in enumerate(chunks):
            covered[k * quality.STEP + np.flatnonzero(chunk)] = True
        assert covered.sum() == size


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (1, None, 1.0), (None, "a b", 2.0), (3, "", 0.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    net = quality.fit(docs, none)
    assert {r.score for r in quality.classify(docs, net).collect()} == {0.5}
    assert sorted(map(tuple, quality.keep_good(docs, net).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    ones = spark.createDataFrame([(3, 1), (None, 0), (3, 1), (1, None)], "doc_id long, quality int")
    assert {r.predicted for r in quality.classify(docs, quality.fit(docs, ones)).collect()} == {1}
    assert quality.classify(docs.limit(0), net).collect() == []
