"""Each stage against a brute-force version on its own input."""

from collections import Counter, defaultdict

import corpus_pipeline
from rolehabit.llm import pii, quality
from rolehabit.llm.common import stored
from tests.llm.test_mixing import targets_by_rule
from tests.llm.test_ngram_join import brute, words_of


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = [tuple(r) for r in docs.collect()]
    place = {c: i for i, c in enumerate(columns)}
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test")
        out.append([tuple(r) for r in docs.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    good, one, clean, mix, coded = out
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    score = quality.scores(net, [(r[place["text"]] or "").encode() for r in before])
    assert Counter(good) == Counter(r for r, s in zip(before, score, strict=True) if s >= 0.5)
    assert len(good) > 0.7 * len(before)

    key, text = place["doc_id"], place["text"]
    stays = {k for k, _, c in brute([(r[key], r[text]) for r in good]) if k == c}
    assert Counter(one) == Counter(r for r in good if r[key] in stays)

    assert len(clean) == len(one)
    rows = {r[key]: r for r in clean}
    hidden = 0
    for r in one:
        new = rows[r[key]]
        spans = pii.base_spans(r[text] or "")
        if spans:
            hidden += 1
            assert not {r[text][a:b] for _, a, b in spans} & set((new[text] or "").split()) and new[place["n_chars"]] == len(new[text])
        else:
            assert new == r
    assert hidden

    sizes, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in clean:
        n = len([w for w in words_of(r[text]) if w])
        sizes[r[place["source"]]] += n
        largest[r[place["source"]]] = max(largest[r[place["source"]]], n)
    for r in mix:
        assert rows[r[key]] == r
        n = len([w for w in words_of(r[text]) if w])
        taken[r[place["source"]]] += n
    assert max(Counter(r[key] for r in mix).values()) <= 3
    goal = targets_by_rule(sizes)
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= largest[s]

    assert {(r[0], r[2]) for r in coded} == {(r[key], r[text] or "") for r in mix}
    ranks = Counter((r[0], r[1]) for r in coded)
    assert all(ranks[r[key], 1] == n for r, n in Counter(mix).items())


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (1, "one two three four five six", "en", None, 1), (2, "", None, "b", 2), (None, "x y", "en", "a", 3),
            (3, "one two three four five six", "en", "b", 9), (3, "one two three four five six", "en", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    one = corpus_pipeline.one_of_each(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in one), key=repr) == [1, 2, None]
    named = docs.selectExpr("*", "7 as n", "8 as Least", "9 as digest", "10 as component_id")
    clashing = corpus_pipeline.one_of_each(spark, named, str(tmp_path))
    assert clashing.columns == named.columns
    got = [tuple(r) for r in clashing.collect()]
    assert sorted((r[0] for r in got), key=repr) == [1, 2, None] and all(r[5:] == (7, 8, 9, 10) for r in got)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []
