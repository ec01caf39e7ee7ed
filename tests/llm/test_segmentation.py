"""Samples against the enumerated lattice, exact round trips, odd rows."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rolehabit.llm import segmentation as seg
from rolehabit.llm.common import QUERIES

VOCABULARY = seg.pieces()


def enumerated(text):
    """{ids: probability} over all segmentations."""
    whole = "".join(seg.words_of(text))
    found = {}

    def walk(at, ids, weight):
        if at == len(whole):
            found[tuple(ids)] = weight
            return
        single = False
        for end in range(at + 1, len(whole) + 1):
            entry = VOCABULARY.known.get(whole[at:end])
            if entry:
                single |= end == at + 1
                walk(end, [*ids, entry[0]], weight * entry[1])
        if not single:
            walk(at + 1, [*ids, *(VOCABULARY.byte_ids[b] for b in whole[at].encode())], weight * VOCABULARY.unknown)

    walk(0, [], 1.0)
    total = sum(found.values())
    return {k: v / total for k, v in found.items()}


def drawn(text, count, samples):
    return seg.sample([(seg._seed(i), text) for i in range(count)], seg.Lattices(VOCABULARY), samples)


@pytest.mark.parametrize("text", ["the in", "a\nb  c", "Ç漢the"])
def test_samples_follow_the_lattice(text):
    exact = enumerated(text)
    count = 4000
    found = drawn(text, count, 3)
    first = Counter(tuple(f[0][0].tolist()) for f in found)
    for ids, p in exact.items():
        assert abs(first[ids] / count - p) < 4 * math.sqrt(p * (1 - p) / count) + 1e-3
    weights = []
    for f in found:
        assert len(f) == min(3, len(exact))
        ids = [tuple(x[0].tolist()) for x in f]
        assert len(set(ids)) == len(ids)
        assert [x[2] for x in f] == sorted((x[2] for x in f), reverse=True)
        for i, x in zip(ids, f, strict=True):
            assert x[1] == pytest.approx(math.log(exact[i]), abs=1e-6)
        weights.append(sum(exact[i] / x[3] for i, x in zip(ids, f, strict=True)))
    # inverse inclusion scores make an unbiased estimate of 1
    assert np.mean(weights) == pytest.approx(1, abs=5 * np.std(weights) / math.sqrt(count) + 1e-9)


def test_second_sample_without_replacement():
    text, count = "the in", 4000
    exact = enumerated(text)
    pairs = Counter(tuple(tuple(x[0].tolist()) for x in f) for f in drawn(text, count, 2))
    for (a, b), n in pairs.most_common(12):
        p = exact[a] * exact[b] / (1 - exact[a])
        assert abs(n / count - p) < 4 * math.sqrt(p / count) + 1e-3


def test_all_segmentations_and_no_more():
    exact = enumerated("it")
    found = drawn("it", 3, 500)
    for f in found:
        assert {tuple(x[0].tolist()) for x in f} == set(exact)
        assert all(x[3] == 1 for x in f)


@pytest.mark.parametrize("text", ["", " ", "a", "  two  spaces \n\n", "𝄞 é\t\r\x00", "x" * 3000, "漢" * 500, "word " * 9000])
def test_round_trip(text):
    for ids, log, value, score in drawn(text, 1, 3)[0]:
        assert seg.decode(ids) == text
        assert math.isfinite(log) and math.isfinite(value) and 0 <= score <= 1


def test_samples_depend_on_the_key_alone():
    texts = [(seg._seed(i), f"some text {i} and more") for i in range(9)]
    together = seg.sample(texts, seg.Lattices(VOCABULARY), 3)
    for one, whole in zip(texts[::-1], together[::-1], strict=True):
        alone = seg.sample([one], seg.Lattices(VOCABULARY), 3)[0]
        assert [x[0].tolist() for x in alone] == [x[0].tolist() for x in whole]
        assert [x[2] for x in alone] == pytest.approx([x[2] for x in whole])


def test_kept_lattices_change_nothing():
    groups = [[(seg._seed(10 * g + i), f"some text {i} of group {g} 漢字 and more " + "y" * g) for i in range(9)] for g in range(6)]
    kept, small = seg.Lattices(VOCABULARY), seg.Lattices(VOCABULARY, kept=60)
    for group in groups:
        alone = seg.sample(group, seg.Lattices(VOCABULARY), 3)
        for lattices in (kept, small):
            got = seg.sample(group, lattices, 3)
            assert [[x[0].tolist() for x in f] for f in got] == [[x[0].tolist() for x in f] for f in alone]
            assert [[x[1:] for x in f] for f in got] == [[pytest.approx(x[1:]) for x in f] for f in alone]
    assert small.nodes < kept.nodes


def test_decoding_columns():
    rows = [[], None, [VOCABULARY.byte_ids[200]] * 2, *(seg.sample([(1, t)], seg.Lattices(VOCABULARY), 1)[0][0][0].tolist() for t in ("a b", "漢𝄞", "\x00\n"))]
    for part in (rows, rows[:2] + rows[3:]):  # with and without ids that are no text
        column = pa.array([None, *part, []], pa.list_(pa.int32()))[1:]
        assert seg.decode_all(column).to_pylist() == [None if r is None else seg.decode(r) for r in [*part, []]]


def test_tables(spark, sf_dir):
    rows = [(1, None, 0), (2, "", 0), (None, "a b", 0), (3, "same", 0), (3, "same", 0), (4, "y " * 9000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank int")
    got = seg.decoded(seg.segmentations(docs, samples=2)).collect()
    texts = {k: t or "" for k, t, _ in rows}
    assert all(r.text == texts[r.doc_id] for r in got)
    assert Counter(r.doc_id for r in got) == {1: 1, 2: 1, None: 2, 3: 4, 4: 2}
    fused = seg.segmentations(docs, samples=2, decoding="decoded text").collect()
    assert sorted(map(tuple, fused), key=repr) == sorted(map(tuple, got), key=repr)
    assert seg.segmentations(docs.limit(0)).collect() == []
    query = QUERIES["op1_segmentation"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert query.select("doc_id").distinct().count() == docs.count()
    from pyspark.sql import functions as F

    assert query.join(docs, "doc_id").where(F.col("text_digest") != F.xxhash64("text")).count() == 0


def test_lattices_that_a_worker_keeps_leave_room_for_others():
    """Two workers of an executor keep 200 MB of arrays at most between them."""
    made = seg.Lattices(VOCABULARY)
    letters = np.random.default_rng(5).integers(97, 123, 60_000).astype(np.uint8).tobytes().decode()
    made.starts([seg.SPACE + letters[i : i + 6] for i in range(0, len(letters), 6)])
    columns = [(made.first, made.nodes), (made.paths, made.nodes), *((c, made.edges) for c in (made.piece, made.to, made.log, made.upto))]
    a_node = sum(c.itemsize * size for c, size in columns) / made.nodes
    assert a_node * made.kept < 100e6


def test_words_that_come_again_stay(monkeypatch):
    """Each group has words of its own; the ones all groups share are made once."""
    made = Counter()
    add = seg.Lattices._add
    monkeypatch.setattr(seg.Lattices, "_add", lambda self, words: (made.update(w.strip(" " + seg.SPACE) for w in words), add(self, words))[1])
    kept = seg.Lattices(VOCABULARY, kept=200)
    for g in range(40):
        text = f"shared words stay {g:030d}"
        got, alone = (seg.sample([(g, text)], lattices, 3)[0] for lattices in (kept, seg.Lattices(VOCABULARY)))
        assert [x[0].tolist() for x in got] == [x[0].tolist() for x in alone] and seg.decode(got[0][0]) == text
    # once by the kept lattices, and once by each of the 40 others
    assert made["shared"] == made["words"] == made["stay"] == 41
    assert kept.nodes <= 200 + len(text) + 1
    # beyond half of the room nothing stays
    full, words = seg.Lattices(VOCABULARY, kept=23), [" shared", " words", " stay", " here"]
    assert [full.starts(w).tolist() for w in (words, words, [" other"], [" x"])] == [[0, 7, 13, 18]] * 2 + [[23], [0]]
    assert full.nodes == 2
