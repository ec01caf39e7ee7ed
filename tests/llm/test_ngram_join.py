"""Components against brute force over all pairs."""

import random

from rolehabit.llm.common import QUERIES
from rolehabit.llm.components import components
from rolehabit.llm.ngram_join import near_duplicates


def words_of(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").translate(dict.fromkeys(map(ord, "\t\n\v\f\r"), " ")).split(" ")


def set_of(text):
    words = [w for w in words_of(text) if w]
    if len(words) < 5:
        return {tuple(words)} - {()}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """{row number: (n, component)}; rows: (key, text)."""
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(i, j) for group in by.values() for i in group for j in group if i < j}
    for i, j in pairs:
        if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(k, least.get(find(i), k))
    return sorted((k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows))


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op6_ngram_join"](spark, sf_dir).collect()))
    assert got == brute(rows)
    assert len({c for _, _, c in got}) < len(got)


def test_pairs_at_the_threshold(spark):
    draw = random.Random(5)
    rows = []
    for base in range(12):
        words = [f"w{draw.randrange(300)}" for _ in range(draw.randint(3, 60))]
        for _ in range(10):  # chains of edits, so that similarities fall on both sides of 0.8
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = f"v{draw.randrange(9)}"
            words.insert(draw.randrange(len(words)), "same")
    common = " ".join(f"c{i}" for i in range(30))
    rows += [(len(rows) + i, f"{common} {' '.join(f'own{i}x{j}' for j in range(5 + i % 5))}") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(frame).collect())) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (5, "A  b"), (6, "a b c"), (7, "x " * 3000), (8, "x " * 50)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int")
    assert sorted(map(tuple, near_duplicates(frame).collect())) == brute(rows)
    null = spark.createDataFrame([(None, "a b"), (9, "a b")], "doc_id long, text string")
    assert sorted(map(tuple, near_duplicates(null).collect()), key=repr) == [(9, 1, 9), (None, 1, None)]
    assert near_duplicates(frame.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (3, 2)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)}
    assert len(got) == 101
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
