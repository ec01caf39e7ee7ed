"""Licence notices in texts, by family.

Method: a trained paragraph classifier.  Paragraphs (lines) are described by the word
n-grams they hold, of one to three words, out of those of the templates.  A sparse
(L1-regularised) logistic regression over all families and one more class, unknown,
is trained on mutilated templates against paragraphs of the corpus; its probabilities are
calibrated by a temperature on held-out examples.  A predicted family is reported only
if the paragraph also covers enough of one of the family's templates.

Scoring is column expressions alone, row by row.  Only n-grams with a weight matter, and
each of them has a word that is rare in the corpus; texts and paragraphs without any of
those words have the probabilities of an empty paragraph, which are those of an unknown one, and
are passed over without loss.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.llm.common import query, table

UNKNOWN = "unknown"
#: Paragraphs of the corpus that training sees as unknown ones, and how much of each.
SAMPLE, SAMPLE_CHARS = 1000, 400
LONGEST = 3
PENALTY, STEPS, SEED = 2e-3, 250, 3
PROBABLE, COVERED = 0.5, 0.6

# Short notices as their licences ask for them.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license", "SPDX-License-Identifier: MIT", "This project is distributed under the terms of the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "Apache": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Released under the Apache License 2.0",
               "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Released under the GNU GPL v3", "SPDX-License-Identifier: GPL-3.0-or-later",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1", "SPDX-License-Identifier: LGPL-2.1-only", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "BSD": ["Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-2-Clause", "Released under the BSD license",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "public domain": ["This is free and unencumbered software released into the public domain.", "Dedicated to the public domain under CC0 1.0 Universal", "SPDX-License-Identifier: Unlicense"],
    "reserved": ["All rights reserved.", "Copyright 2020 by the authors. All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited"],
}
#: Paragraphs that speak of licences and grant none.
NEITHER = ["the license plate of the car", "copyright law protects the authors of a work", "permission to use the public road is granted by the general", "the apache people", "he drove under the influence without a license",
           "the software was published in the international press", "free copy of the file", "a public work of the creative commons", "version 2.0 of the text", "by the terms of the contract"]


@dataclass
class Model:
    classes: list[str]
    grams: list[str]  # those with a weight
    weights: np.ndarray  # grams by classes, over the temperature
    bias: np.ndarray
    words: list[str]  # every gram has one of them at least


def words_of(paragraph: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", paragraph.lower())


def grams_of(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, LONGEST + 1) for i in range(len(words) - n + 1)}


def _mutilated(words: list[str], draw: np.random.Generator, count: int) -> list[list[str]]:
    """The words, and versions with a part cut off, words left out, numbers changed or words around."""
    out = [words]
    while len(out) < count:
        kept = max(2, int(np.ceil(len(words) * draw.uniform(0.7, 1))))
        start = int(draw.integers(0, len(words) - kept + 1))
        some = [str(draw.integers(1, 9)) if w.isdigit() and draw.random() < 0.3 else w for w in words[start : start + kept] if draw.random() > 0.05]
        out.append(some or words)
    return out


def train(unknown: list[str], seed: int = SEED) -> Model:
    """Fit and calibrate; ``unknown``: paragraphs that are no notices, as far as they cover no template."""
    draw = np.random.default_rng(seed)
    classes = [UNKNOWN, *TEMPLATES]
    pairs = [(f, {" ".join(p) for p in zip(w, w[1:], strict=False)}) for f, ts in TEMPLATES.items() for w in map(words_of, ts)]
    others = [w for w in map(words_of, unknown) if not any(len(t & {" ".join(p) for p in zip(w, w[1:], strict=False)}) > 0.4 * len(t) for _, t in pairs)]
    common = Counter(w for words in others for w in set(words))
    # words of more than one in two hundred paragraphs tell nothing by themselves
    usual = {w for w, n in common.items() if n > max(2, len(others) / 200)} | set(words_of(" ".join(NEITHER))) - {"license", "copyright", "permission"}
    examples = [(0, w) for w in others] + [(0, w) for t in NEITHER for w in _mutilated(words_of(t), draw, 8)] + [(0, [])] * 20
    for k, family in enumerate(TEMPLATES, 1):
        for template in TEMPLATES[family]:
            examples += [(k, w) for w in _mutilated(words_of(template), draw, 24)]
            # the same within other text
            if others:
                examples += [(k, [*others[int(draw.integers(len(others)))], *words_of(template)]) for _ in range(4)]
    vocabulary = sorted({g for t in TEMPLATES.values() for x in t for g in grams_of(words_of(x)) if not set(g.split()) <= usual})
    index = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(examples), len(vocabulary)), np.float32)
    for r, (_, words) in enumerate(examples):
        x[r, [index[g] for g in grams_of(words) if g in index]] = 1
    y = np.array([k for k, _ in examples])
    held = draw.random(len(y)) < 0.2
    target = np.eye(len(classes), dtype=np.float32)[y]
    weights, bias = np.zeros((len(vocabulary), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    ahead, before, momentum = weights, weights, 1.0
    a, b = x[~held], target[~held]
    rate = 4 / max(1.0, float((a * a).sum(axis=1).max()))
    for _ in range(STEPS):  # accelerated proximal gradient
        logits = a @ ahead + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - b) / len(a) * 20
        moved = ahead - rate * (a.T @ error)
        before, weights = weights, np.sign(moved) * np.maximum(np.abs(moved) - rate * PENALTY * 20, 0)
        bias = bias - rate * error.sum(axis=0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, momentum = weights + (momentum - 1) / following * (weights - before), following
    logits = x[held] @ weights + bias

    def loss(temperature: float) -> float:
        z = logits / temperature
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), y[held]]).mean())

    best = min(np.geomspace(0.1, 4, 40), key=loss)
    used = np.flatnonzero(np.abs(weights).max(axis=1) > 0)
    grams = [vocabulary[i] for i in used]
    left, words = [set(g.split()) - usual for g in grams], []
    while left:  # the words that the most grams have
        word = max(sorted(set().union(*left)), key=lambda w: sum(w in g for g in left))
        words.append(word)
        left = [g for g in left if word not in g]
    return Model(classes, grams, weights[used] / best, bias / best, words)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Train with a bounded sample of the corpus' paragraphs, in the order of a hash, as unknown ones."""
    line = F.split(F.col(text), "\n")
    some = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("h"), line.alias("lines"))
    # cut before they are ordered: each task sends SAMPLE short rows at most
    some = some.select("h", F.substring(F.element_at("lines", (F.pmod("h", F.size("lines")) + 1).cast("int")), 1, SAMPLE_CHARS).alias("p"))
    some = some.orderBy("h", "p").limit(SAMPLE)
    return train([r.p for r in some.collect()])


def _any_of(words: list[str]) -> str:
    by: dict[str, list[str]] = {}
    for w in sorted(words):
        by.setdefault(w[0], []).append(w[1:])
    return "(?<![a-z0-9])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by.items()) + ")(?![a-z0-9])"


def _texts(values: list[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")  # letters, digits and spaces


def _numbers(values) -> str:
    return "array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")"


def _once(frame: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """Columns that what follows may use several times and that are still worked out once."""
    return frame.select(*keep, F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def notices(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per notice: key, paragraph (its number, from 0), family, probability, similarity.

    Null and empty texts have none.  Repeated rows repeat their notices, null keys are
    kept; other columns are left behind; an empty table gives an empty one.  Paragraphs
    are looked at whole and each by itself; one pass without a shuffle.
    """
    hint = _any_of(model.words)
    lines = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("t")).where(F.col("t").rlike(hint))
    lines = lines.select("key", F.posexplode(F.split("t", "\n")).alias("paragraph", "line")).where(F.col("line").rlike(hint))
    lines = _once(lines, "key", "paragraph", words=F.filter(F.split("line", "[^a-z0-9]+"), lambda w: w != ""))

    def runs(n: int) -> Column:
        starts = F.when(F.size("words") >= n, F.sequence(F.lit(1), F.size("words") - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice("words", i, n), " "))

    grams = F.concat(*(runs(n) for n in range(1, LONGEST + 1)))
    lines = _once(lines, "key", "paragraph", pairs=runs(2), held=F.array_intersect(grams, _texts(model.grams)))
    weights = F.expr(f"array({', '.join(map(_numbers, model.weights))})")
    place = lambda g: F.array_position(_texts(model.grams), g).cast("int")
    logits = F.aggregate("held", F.expr(_numbers(model.bias)), lambda acc, g: F.zip_with(acc, F.element_at(weights, place(g)), lambda a, w: a + w))
    lines = _once(lines, "key", "paragraph", "pairs", logits=logits)
    lines = _once(lines, "key", "paragraph", "pairs", "logits", most=F.array_max("logits"))
    classes = F.expr("array(" + ", ".join(f"'{c}'" for c in model.classes) + ")")
    scored = _once(
        lines, "key", "paragraph", "pairs",
        family=F.element_at(classes, F.array_position("logits", F.col("most")).cast("int")),
        probability=1 / F.aggregate(F.transform("logits", lambda z: F.exp(z - F.col("most"))), F.lit(0.0), lambda a, e: a + e),
    )
    scored = scored.where((F.col("family") != UNKNOWN) & (F.col("probability") >= PROBABLE))
    covers = F.lit(0.0)
    for family, templates in TEMPLATES.items():
        shares = []
        for template in templates:
            own = words_of(template)
            pairs = sorted({" ".join(p) for p in zip(own, own[1:], strict=False)})
            shares.append(F.size(F.array_intersect("pairs", _texts(pairs))) / len(pairs))
        covers = F.when(F.col("family") == family, F.greatest(*shares, F.lit(0.0))).otherwise(covers)
    scored = _once(scored, "key", "paragraph", "family", "probability", similarity=covers).where(F.col("similarity") >= COVERED)
    return scored.select(F.col("key").alias(key), "paragraph", "family", "probability", "similarity")


@query()
def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return notices(docs, fit(docs))
