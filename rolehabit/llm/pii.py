"""Personal data in texts, and the terms that would give it away.

Base findings are fixed patterns: e-mail, IP address, card and phone numbers.

Method for the rest: information-theoretic sanitisation.  Each distinct base value is a
protected entity e.  A term t discloses

    log(P(e | t) / P(e)) / log(1 / P(e))

of the information that names e, with P(e) the share of the texts that hold e, and P(e | t)
that of the texts with t, smoothed by ``WEIGHT`` texts of which P(e) hold e.  Where the share
reaches ``DISCLOSURE`` and no more than ``LEFT`` bits about e are left, the term is a finding in
every text that holds it, with or without e.  Repeated texts count once, so copies prove
nothing.  A word seen in one text alone
names a rare entity of that text within a bit.

Texts stay where they are.  What is shuffled are hashes: the entities of texts, counts of
terms added up by task, and the terms of texts with entities that are rare enough to matter.
Entities held by the same texts are one class, so that a long list of addresses meets
the terms beside it once.  Filters of fixed size hold back what cannot matter; what passes is
joined exactly.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.llm.common import map_batches, query, stored, table

KINDS = ("email", "ip", "card", "phone")
WEIGHT, DISCLOSURE, LEFT = 1.0, 0.8, 1.0
#: Bits of each filter; 1 MB whatever the corpus.
FILTER_BITS = 1 << 23
#: Counts a task holds before it passes them on.
HELD = 1 << 18
#: Disclosing terms sent to every task, 4 MB of hashes; more are joined to the texts that hold them.
SENT = 1 << 19

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits that fails from its first digit fails from each of the others
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]")
_TERM = re.compile(r"[^\W_]{3,}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _byte(digits: str) -> bool:
    """At most 255, however many zeros come first."""
    bare = digits.lstrip("0")
    return len(bare) <= 3 and int(bare or "0") <= 255


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and then start; matches that fail a test are dropped."""
    found = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(map(_byte, m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if len(m[0]) >= 13 and 13 <= len(digits := _NOT_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def _entity(kind: str, value: str) -> int:
    """Equal numbers in other groupings, and addresses in other cases, are one entity."""
    plain = value.lower() if kind in ("email", "ip") else _NOT_DIGITS.sub("", value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{plain}") - (1 << 63)


def entities(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int]]:
    return [(_entity(kind, text[a:b]), a, b) for kind, a, b in spans]


def terms_of(text: str, spans: list[tuple[str, int, int]]) -> Iterator[re.Match]:
    """Words of three letters or digits or more that no span covers."""
    covered = sorted((a, b) for _, a, b in spans)
    k, reached = 0, 0
    for word in _TERM.finditer(text):
        while k < len(covered) and covered[k][0] < word.end():
            reached = max(reached, covered[k][1])
            k += 1
        if word.start() >= reached:
            yield word


def _hash(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) - (1 << 63)


def _words(text: str, spans: list[tuple[str, int, int]] = ()) -> set[str]:
    return {w.lower() for w in ({m[0] for m in terms_of(text, spans)} if spans else set(_TERM.findall(text)))}


def _batch(rows: Collection[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _filter(frame: DataFrame, column: str) -> bytes:
    """A field of ``FILTER_BITS`` bits with those of a column of hashes set."""
    marks = np.zeros(FILTER_BITS, np.uint8)
    bits = frame.select(F.pmod(column, F.lit(FILTER_BITS)).cast("int").alias("bit")).distinct()
    for row in bits.groupBy((F.col("bit") / 4096).cast("int")).agg(F.collect_list("bit").alias("bits")).toLocalIterator():
        marks[row.bits] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def _in(bits: bytes, key: int) -> int:
    place = key % FILTER_BITS
    return bits[place >> 3] >> (place & 7) & 1


def _digested(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.xxhash64(text).alias("digest"), F.col(text).alias("t")).where("t is not null")


def _facts(texts: DataFrame, copied: bytes) -> DataFrame:
    """(digest, entity, term, n): each text's entities, and how many texts hold each term.

    Counts are added up within a task under a null digest; texts that may have copies
    elsewhere keep theirs.
    """
    shared = texts.sparkSession.sparkContext.broadcast(copied)
    names = ["digest", "entity", "term", "n"]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, counts, own = shared.value, Counter(), set()

        def flushed() -> Iterator[pa.RecordBatch]:
            yield _batch(own, names)
            own.clear()
            terms, n = (pa.array(np.fromiter(x, np.int64, len(counts))) for x in (map(_hash, counts), counts.values()))
            counts.clear()
            nothing = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([nothing, nothing, terms, n], names)

        for batch in rows:
            for digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = base_spans(text)
                own.update((digest, entity, None, 1) for entity, _, _ in entities(text, spans))
                if _in(bits, digest):
                    own.update((digest, None, _hash(w), 1) for w in _words(text, spans))
                else:
                    counts.update(_words(text, spans))
                if len(counts) + len(own) > HELD:
                    yield from flushed()
        yield from flushed()

    return map_batches(texts, batches, "digest long, entity long, term long, n long")


def _held(texts: DataFrame, terms: bytes, digests: bytes | None = None) -> DataFrame:
    """(digest, term): the terms of each text that pass a filter, of texts that pass another."""
    context = texts.sparkSession.sparkContext
    wanted, among = context.broadcast(terms), context.broadcast(digests)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, some = wanted.value, among.value
        for batch in rows:
            for digest, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if some is not None and not _in(some, digest):
                    continue
                found = [(digest, term) for term in map(_hash, _words(text, base_spans(text))) if _in(bits, term)]
                if found:
                    yield _batch(found, ["digest", "term"])

    return map_batches(texts, batches, "digest long, term long").distinct()


def disclosing_terms(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term): hashes of the terms that give an entity away, by counts over all texts."""
    texts = _digested(docs, text)
    copies = stored(texts.groupBy("digest").count(), "copies")
    total = max(2, copies.count())
    facts = stored(_facts(texts, _filter(copies.where("count > 1"), "digest")), "facts")
    beside = facts.where("entity is not null").select("digest", "entity").distinct()
    by_holders = beside.groupBy("entity").agg(
        F.count("digest").alias("holders"), *(F.bit_xor(F.xxhash64("digest", F.lit(k))).alias(f"x{k}") for k in (1, 2))
    )
    group = F.xxhash64("holders", "x1", "x2").alias("class")
    classes = stored(beside.join(by_holders, "entity").select("digest", group, "holders").distinct(), "classes")
    most = classes.agg(F.max("holders")).first()[0] or 0
    of_copies = facts.where("term is not null and digest is not null").select("term", "n", "digest").distinct().drop("digest")
    counts = facts.where("term is not null and digest is null").select("term", "n").union(of_copies)
    counts = counts.groupBy("term").agg(F.sum("n").alias("texts"))
    # P(e | t) above 1/2 ** LEFT leaves a term that few more texts hold than its entity
    bound = lambda holders: (holders + WEIGHT) * 2**LEFT
    rare = stored(counts.where(F.col("texts") <= bound(F.lit(most))), "rare")
    held = _held(texts, _filter(rare, "term"), _filter(classes, "digest")).join(rare, "term")
    pairs = held.join(classes, "digest").where(F.col("texts") <= bound(F.col("holders")))
    pairs = pairs.groupBy("class", "holders", "term", "texts").agg(F.count("digest").alias("together"))
    prior = F.least("holders", F.lit(total - 1)) / total
    given = (F.col("together") + WEIGHT * prior) / (F.col("texts") + WEIGHT)
    discloses = (F.log(given / prior) >= DISCLOSURE * F.log(1 / prior)) & (-F.log2(given) <= LEFT)
    return pairs.where(discloses).select("term").distinct()


def with_additions(docs: DataFrame, text: str = "text", name: str = "__terms") -> tuple[DataFrame, Callable]:
    """``docs`` with one more column, and a function of a text and its value there.

    It gives the hashes of the disclosing terms among the words of the text.  Up to ``SENT`` terms
    are broadcast; beyond, the column holds those of each text.
    """
    known = stored(disclosing_terms(docs, text), "disclosing")
    if known.count() <= SENT:
        hashes = np.array([r.term for r in known.collect()], np.int64)
        shared = docs.sparkSession.sparkContext.broadcast(hashes.tobytes())
        held: list[frozenset] = []

        def among(t: str, _: None) -> set[int]:
            if not held:
                held.append(frozenset(np.frombuffer(shared.value, np.int64).tolist()))
            return held[0].intersection(map(_hash, _words(t))) if held[0] else set()

        return docs.withColumn(name, F.lit(None).cast("array<bigint>")), among
    found = _held(_digested(docs, text), _filter(known, "term")).join(known, "term")
    # a text's terms are at most its own words
    added = stored(found.groupBy("digest").agg(F.collect_set("term").alias("terms")), "added")
    added = added.select(F.col("digest").alias("__digest"), F.col("terms").alias(name))
    listed = docs.withColumn("__text_digest", F.xxhash64(text)).join(added, F.col("__text_digest") == F.col("__digest"), "left")
    return listed.drop("__digest", "__text_digest"), lambda _, terms: terms


def all_spans(text: str, terms: Collection[int] | None) -> list[tuple[str, int, int]]:
    spans = base_spans(text)
    if terms:
        wanted = set(terms)
        spans = spans + [("term", *w.span()) for w in terms_of(text, spans) if _hash(w[0].lower()) in wanted]
    return spans


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_email, n_ip, n_card, n_phone, n_term, spans.

    spans: array of (kind, start, end), code points, by kind and start.  Null texts count
    as empty.  Null keys and repeated rows keep one row each; other columns are left
    behind; an empty table gives an empty one.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [*KINDS, "term"]
    listed, among = with_additions(docs.select(key, text), text)
    rows_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [all_spans(t or "", among(t or "", w)) for t, w in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in found], pa.int64()) for k in names]
            spans = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in found], rows_type)
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, spans], [key, *(f"n_{k}" for k in names), "spans"])

    schema = f"`{key}` {kind}, {', '.join(f'n_{k} long' for k in names)}, spans array<struct<kind:string,start:long,end:long>>"
    return map_batches(listed, batches, schema)


def sanitised(text: str, terms: Collection[int] | None) -> str:
    """The text with every finding replaced by its kind; overlapping ones by the first one's."""
    out, reached = [], 0
    for kind, a, b in sorted(all_spans(text, terms), key=lambda s: (s[1], -s[2])):
        if a >= reached:
            out += [text[reached:a], f"[{kind.upper()}]"]
        reached = max(reached, b)
    return "".join([*out, text[reached:]])


def sanitise(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with findings in ``text`` replaced by their kinds, and ``length`` set anew.

    Rows without findings stay as they are, null texts too.
    """
    names = docs.columns
    at = names.index(text)
    size = names.index(length) if length in names else None
    listed, among = with_additions(docs, text)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            columns = list(batch.columns[:-1])
            old = columns[at].to_pylist()
            new = [None if t is None else sanitised(t, among(t, w)) for t, w in zip(old, batch.columns[-1].to_pylist(), strict=True)]
            columns[at] = pa.array(new, columns[at].type)
            if size is not None:
                lengths = [n if x == y else len(y) for n, x, y in zip(columns[size].to_pylist(), old, new, strict=True)]
                columns[size] = pa.array(lengths, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(listed, batches, docs.schema)


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"))
