"""Notices against those written into the documents; families, unknowns, odd rows."""

import re

import numpy as np
import pytest

from rolehabit.llm import licences
from rolehabit.llm.common import QUERIES

WRITTEN = {
    "MIT": r"Released under the MIT License\.", "Apache": r"Licensed under the Apache License, Version \d\.\d\.", "CC-BY-NC": r"Licensed under CC BY-NC \d\.\d\.",
    "GPL": r"This work is licensed under the GNU General Public License, version \d\.", "reserved": r"All rights reserved\.",
}


def plain_scores(model, paragraph):
    held = licences.grams_of(licences.words_of(paragraph)) & set(model.grams)
    z = model.bias + sum((model.weights[model.grams.index(g)] for g in held), np.zeros(len(model.classes)))
    p = np.exp(z - z.max())
    return p / p.sum()


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return licences.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_query_finds_what_is_written(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    wanted = {(k, i, f) for k, t in docs.items() for i, line in enumerate(t.split("\n")) for f, p in WRITTEN.items() if re.search(p, line)}
    got = {(r.doc_id, r.paragraph, r.family) for r in QUERIES["op8_licences"](spark, sf_dir).collect()}
    assert wanted and got == wanted


def test_columns_equal_plain_scores(spark, model):
    paragraphs = [t for ts in licences.TEMPLATES.values() for t in ts] + licences.NEITHER + ["", "license", "MIT", "mit license of the apache", "x " * 500 + "Released under the MIT License."]
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(paragraphs)], "doc_id int, text string")
    got = {r.doc_id: r for r in licences.notices(frame, model).collect()}
    for i, p in enumerate(paragraphs):
        score = plain_scores(model, p)
        best = model.classes[int(score.argmax())]
        if i in got:
            assert got[i].family == best and got[i].probability == pytest.approx(score.max(), rel=1e-5)
        elif best != licences.UNKNOWN and score.max() >= licences.PROBABLE:
            assert p not in [t for ts in licences.TEMPLATES.values() for t in ts]
    families = {p: f for f, ts in licences.TEMPLATES.items() for p in ts}
    hits = [got[i].family == families[p] for i, p in enumerate(paragraphs) if p in families and i in got]
    assert all(hits) and len(hits) >= 0.9 * len(families)
    assert not any(p in licences.NEITHER for i, p in enumerate(paragraphs) if i in got)


def test_passing_over_loses_nothing(model):
    assert model.classes[int(plain_scores(model, "").argmax())] == licences.UNKNOWN
    assert all(set(g.split()) & set(model.words) for g in model.grams)


def test_odd_rows(spark, model):
    line = "Licensed under the Apache License, Version 2.0."
    rows = [(1, None), (2, ""), (None, line), (3, f"a\n{line}\nb"), (3, f"a\n{line}\nb"), (4, "word " * 30_000 + "\n" + line.upper())]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, family int")
    got = sorted(((r.doc_id, r.paragraph, r.family) for r in licences.notices(frame, model).collect()), key=repr)
    assert got == sorted([(None, 0, "Apache"), (3, 1, "Apache"), (3, 1, "Apache"), (4, 1, "Apache")], key=repr)
    assert licences.notices(frame.limit(0), licences.fit(frame.limit(0))).collect() == []
