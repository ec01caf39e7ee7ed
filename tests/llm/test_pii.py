"""Base findings against the plain patterns, terms against counts by hand."""

import hashlib
import math
import random
import re
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.compute as pc
import pytest

from rolehabit.llm import pii
from rolehabit.llm.common import QUERIES


def plain(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return found


def test_base_spans_equal_the_patterns():
    draw = random.Random(3)
    pieces = ["a@b.c", "@", "x.y+z", ".", "a@b", "a.b@c-d.e.f", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "4041894974608795", "+1 (988) 555-2485", "+1234", "+", " ", "-", "00001.2.3.4", "٣.1.1.1", "é@b.c", "9" * 25, "000000000000000"]
    for _ in range(5000):
        text = "".join(draw.choice(pieces) + draw.choice(["", " ", ".", "\n"]) for _ in range(draw.randint(1, 8)))
        assert pii.base_spans(text) == plain(text), text


def test_numbers_of_any_length():
    for text, kinds in {"0" * 5000 + ".1.1.1": ["ip"], "0" * 5000 + "256.1.1.1": [], "9" * 9000 + ".1.1.1": [], "1.1.1." + "0" * 9000: ["ip"]}.items():
        assert [s[0] for s in pii.base_spans(text)] == kinds
    assert pii.base_spans("+" + "1" * 100000) == [] and pii.base_spans("4" * 100000) == []


def test_query_equals_the_patterns(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op10_pii"](spark, sf_dir).collect()
    assert len(rows) == len(docs) and any(r.n_email for r in rows)
    for r in rows:
        spans = plain(docs[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert [s for s in r.spans.split(",") if s and not s.startswith("term")] == [s for s in joined.split(",") if s]


def plain_terms(texts):
    """Disclosing terms by counts over distinct texts, entity by entity."""
    held = []
    for t in {t for t in texts if t is not None}:
        spans = pii.base_spans(t)
        held.append(({(k, t[a:b].lower()) for k, a, b in spans}, {w[0].lower() for w in pii.terms_of(t, spans)}))
    total = max(2, len(held))
    found = set()
    for e in set().union(*(h[0] for h in held)):
        prior = min(sum(e in es for es, _ in held), total - 1) / total
        for t in set().union(*(ts for es, ts in held if e in es)):
            with_t = [es for es, ts in held if t in ts]
            given = (sum(e in es for es in with_t) + pii.WEIGHT * prior) / (len(with_t) + pii.WEIGHT)
            if math.log(given / prior) >= pii.DISCLOSURE * math.log(1 / prior) and -math.log2(given) <= pii.LEFT:
                found.add(t)
    return found


@pytest.mark.parametrize("sent", [pii.SENT, 0])
def test_terms_that_name_an_entity(spark, monkeypatch, sent):
    monkeypatch.setattr(pii, "SENT", sent)
    words = ["alpha", "beta", "gamma", "delta", "omega"]
    texts = [f"the zebrafinch {w} wrote from k.m@x.org with the {w}" for w in words]
    texts += [f"the {w} and nothing else {i}" for i, w in enumerate(words * 20)]
    texts += ["the alpha zebrafinch without", None, "", texts[0], "Zebrafinch far " + "away " * 40 + "k.m@x.org"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a@b.c", "y")], "doc_id long, text string, spans string")
    known = plain_terms([*texts, "a@b.c"])
    assert known == {"zebrafinch", "wrote", "from", "with"}
    assert {r.term for r in pii.disclosing_terms(docs).collect()} == {pii._hash(t) for t in known}
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    assert len(found) == len(texts) + 1
    assert [s.start for s in found[0].spans if s.kind == "term"] == [4, 21, 27, 42]
    assert [(s.kind, s.start) for s in found[105].spans] == [("term", 10)]  # the name alone, without its address
    assert all(found[i].n_term == 0 for i in range(5, 105))
    clean = {r.doc_id: (r.text, r.spans) for r in pii.sanitise(docs).collect()}
    assert clean[1][0] == "the [TERM] beta [TERM] [TERM] [EMAIL] [TERM] the beta"
    assert clean[105][0] == "the alpha [TERM] without" and clean[10] == (texts[10], "x")
    assert clean[106][0] is None and clean[None][0] == "[EMAIL]"


def test_terms_equal_counts_by_hand(spark, sf_dir):
    draw = random.Random(8)
    people, common = [f"person{i}" for i in range(12)], [f"word{i}" for i in range(30)]
    texts = []
    for _ in range(300):
        who = draw.choice(people)
        parts = draw.choices(common, k=6) + draw.choices([f"{who} {who}@mail.org"] * 3 + [who, "10.0.0.1", f"rare{draw.randrange(400)}"], k=2)
        texts += [" ".join(draw.sample(parts, len(parts)))] * draw.choice([1, 1, 1, 4])
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    known = plain_terms(texts)
    assert known & set(people) and {r.term for r in pii.disclosing_terms(docs).collect()} == {pii._hash(t) for t in known}
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = plain_terms([r.text for r in given.collect()])
    assert {r.term for r in pii.disclosing_terms(given).collect()} == {pii._hash(t) for t in known}


def test_copies_prove_nothing(spark):
    """Fifty copies of a text weigh as one; a list of addresses meets its text's terms once."""
    texts = ["lone k.m@x.org"] * 50 + [f"lone other{i}" for i in range(3)] + [f"filler{i}" for i in range(40)]
    texts.append("listing " + " ".join(f"a{i}@x.org" for i in range(3000)))
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    assert {r.term for r in pii.disclosing_terms(docs).collect()} == {pii._hash("listing")}


def test_lengths_and_empty(spark):
    docs = spark.createDataFrame([("a@b.c d", 7, 1), ("é", 99, 2)], "text string, n_chars long, doc_id long")
    assert sorted(map(tuple, pii.sanitise(docs).collect())) == [("[EMAIL] d", 9, 1), ("é", 99, 2)]
    assert pii.find(docs.limit(0)).collect() == [] and pii.sanitise(docs.limit(0)).collect() == []


def test_what_a_worker_holds(monkeypatch):
    """Counts of 399,000 distinct words take 48 MB at most at once, and next to nothing stays for the tasks after it."""
    monkeypatch.setattr(pii, "map_batches", lambda frame, function, schema: function)
    context = SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value))
    run = pii._facts(SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context)), bytes(pii.FILTER_BITS // 8))
    texts = (" ".join(f"w{i:07d}" for i in range(k, k + 1000)) + " often a@b.c" for k in range(0, 400_000, 1000))
    rows = (pa.RecordBatch.from_arrays([pa.array([k]), pa.array([t])], ["digest", "t"]) for k, t in enumerate(texts))
    assert sum(batch.num_rows for batch in run(iter([next(rows)]))) == 1002  # what is loaded by then does not count
    tracemalloc.start()
    try:
        found = []
        for batch in run(rows):
            _, entity, term, n = batch.columns
            found.append((len(term) - term.null_count, set(entity.drop_null().to_pylist()), pc.sum(n.filter(term.is_valid())).as_py() or 0))
        held, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert sum(f[0] for f in found) >= 399_001 and sum(f[2] for f in found) == 399_399
    assert set().union(*(f[1] for f in found)) == {pii._entity("email", "a@b.c")}
    assert held < 4e6 and most < 48e6
