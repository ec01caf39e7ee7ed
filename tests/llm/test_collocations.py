"""Phrases against counting in Python; the index against plain counts; odd texts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from rolehabit.llm import collocations as co
from rolehabit.llm.common import QUERIES, SQL
from tests.oracle import connect, spark_rows, sql_rows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """(lang, text) rows."""
    f = {}
    for lang, text in rows:
        counts = f.setdefault(lang or "und" if lang != "" else "", Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            counts.update(tuple(words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        found = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        inside = Counter()
        for p, c in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], c)
        best = []
        for p, a in found.items():
            if inside[p] < a:
                score, _, l, r = min((1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def texts(seed, count):
    draw = random.Random(seed)
    some = ["a", "B", "c", "é", "É", "dd", "e\x1cf", "\xa0", "x-y", "\x00"]
    joins = [" "] * 8 + ["\t", "  ", ". ", ",", "\n", "\r\n", "! ?", " ; "]
    rows = []
    for i in range(count):
        words = [draw.choice(some[: draw.choice([2, 4, 10])]) for _ in range(draw.choice([0, 1, 3, 30, 90]))]
        rows.append((draw.choice(["en", "en", "de", None, "und"]), "".join(w + draw.choice(joins) for w in words)))
    return rows + [("en", None), ("fr", ""), ("es", " . , "), ("en", "b " * 500), ("en", "a b c a b c " * 40), ("de", "q" * 3000 + " r s")]


@pytest.mark.parametrize("shard, size, many", [((1 << 21, 1 << 26), 1 << 20, 60), ((300, 1 << 26), 16, 60), ((7, 1 << 26), 1, 3), ((1 << 21, 300), 9, 20)])
def test_agrees_with_counting(spark, shard, size, many):
    rows = texts(1, many)[-many - 3 if many < 10 else 0 :]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, word string, place int").repartition(3)
    got = sorted(map(tuple, co.collocations(frame, least=5, top=40, shard_words=shard[0], shard_bytes=shard[1], slice_bytes=size).collect()))
    assert got == brute(rows, 5, 40) and len(got) > 7


def test_intervals_are_plain_counts():
    draw = np.random.default_rng(1)
    text = np.concatenate(([0], draw.integers(0, 4, 400), [0]))
    text = text[(text != 0) | (np.concatenate(([1], text[:-1])) != 0)]
    order, before = co.transform(text)
    assert sorted(order) == list(range(len(text))) and (before == text[order - 1]).all()
    many = np.bincount(text)
    low, size = (np.cumsum(many) - many)[1:], many[1:]
    names = [(w,) for w in range(1, 4)]
    for length in range(2, 6):
        prefix, suffix, low, size, less = co.extended(before, np.empty(0, np.int64), low, size, length)
        names = [names[p] + names[s][-1:] for p, s in zip(prefix, suffix, strict=True)]
        plain = Counter(tuple(text[i : i + length]) for i in range(len(text) - length + 1) if text[i : i + length].all())
        assert dict(zip(names, size, strict=True)) == plain and not less.any()


@pytest.mark.parametrize("text", [[0, 1, 0], [0, 1, 2, 0], [0, 1, 0, 2, 0]])
def test_short_shards(text):
    order, before = co.transform(np.array(text, np.int32))
    assert sorted(order) == list(range(len(text))) and [text[i - 1] for i in order] == before.tolist()


def test_slices_keep_words_whole():
    data = b"one  two,three\tfour.five " * 5 + b"long" * 20
    for size in (1, 3, 10, 1000):
        parts = list(co.slices(data, size))
        assert b"".join(parts) == data and sum(map(co.words, parts), []) == co.words(data)


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([(1, 4 * 10**12, 10**13)], "i int, f long, n long")
    wide = "cast({} as decimal(19, 0))".format
    assert rows.selectExpr(f"(1000 * {wide('f')} * {wide('n')}) div ({wide('f')} * {wide('f + 1')}) AS s").first().s == 1000 * 10**13 // (4 * 10**12 + 1)


def test_empty(spark):
    frame = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(frame).collect() == []
    assert co.collocations(spark.createDataFrame([(None, None), ("en", " ")], "lang string, text string"), least=1).collect() == []


def test_query_agrees_with_sql(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smaller table has few phrases of a hundred occurrences
    names, rows = spark_rows(QUERIES["op13_collocations"](spark, sf_dir))
    assert (names, rows) == sql_rows(connect(sf_dir), SQL["op13_collocations"]) and len(rows) > 50
