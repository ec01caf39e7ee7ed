"""Phrases whose words stand together more often than their parts would by chance.

Method: an FM-index per shard over word ids.  A task numbers the words of its texts as they
come and closes a shard after ``SHARD_WORDS`` of them.  The shard's suffixes are sorted by
their first ``LONGEST`` words, no further; the words before them, in that order, are the
index (a Burrows-Wheeler transform).  The phrases of m words are intervals of its rows.

Intervals grow by a word on either side at once.  A step to the word before (LF) leads from
every row of the interval of ``w2 .. wm`` to a row of ``w1 .. wm``, which lies in the
interval of ``w1 .. wm-1``; rows with the same two are the interval of the longer phrase, so
one pass over the rows extends all intervals of a shard to the left and to the right.

A phrase is frequent only if both of its parts are, and counts of shards add up.  So one
round for each length sums the shards' counts by the pair of parts, keeps what is frequent,
and sends the shards their own intervals back.  A frequent phrase is named by one of its
intervals (shard and row), which no other phrase of its length has; no digest is involved.
Every row of the sums is one phrase of one shard, however often it occurs there.

Documents are read in slices, and a document that goes on in the next shard takes its last
words along, so neither a document nor a piece need fit into a shard.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolehabit.llm.common import map_batches, query, ship, stored, table

LONGEST = 5
LEAST = 100
TOP = 2000
#: A shard is closed after so many words or bytes; documents are read in slices of so many bytes.
SHARD_WORDS, SHARD_BYTES, SLICE = 1 << 22, 1 << 26, 1 << 20
#: Bits of a row within a shard, and of a shard's number within its task.
ROW_BITS, SHARD_BITS = 27, 16
#: Rows handed to Spark at once.
AT_ONCE = 1 << 16

#: Characters between pieces, and between words.
ENDS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
_TO_STOP = bytes.maketrans(ENDS, b"." * len(ENDS))
_AFTER = re.compile(b"[" + re.escape(ENDS + SPACES) + b"]")


def slices(data: bytes, size: int) -> Iterator[bytes]:
    """A text cut after spaces or ends of pieces, never within a word."""
    start = 0
    while start < len(data):
        found = _AFTER.search(data, start + size - 1)
        stop = found.end() if found else len(data)
        yield data[start:stop]
        start = stop


def words(data: bytes) -> list[bytes]:
    """Words in lower case (A-Z only), with a full stop for each end of a piece."""
    return data.translate(_TO_STOP).replace(b".", b" . ").lower().split()


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks; the keys are overwritten."""
    order = np.argsort(keys)
    keys = keys[order]
    ranks = np.empty(len(keys), np.int32)
    ranks[0] = 0
    np.cumsum(keys[1:] != keys[:-1], out=ranks[1:], dtype=np.int32)
    del keys
    out = np.empty_like(ranks)
    out[order] = ranks
    return out


def transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes (by ``LONGEST`` = 5 ids) and the ids before them; text ends with 0."""
    base = int(text.max()) + 1

    def joined(ids: np.ndarray, times: int, later: np.ndarray, by: int) -> np.ndarray:
        keys = ids.astype(np.int64)
        keys *= times
        keys[: max(0, len(keys) - by)] += later[by:]
        return keys

    pairs = _ranks(joined(text, base, text, 1))
    fours = _ranks(joined(pairs, int(pairs.max()) + 1, pairs, 2))
    del pairs
    order = np.argsort(joined(fours, base, text, 4)).astype(np.int32)
    return order, text[order - 1].astype(np.int32)


class Shard:
    """Word ids as they come, 0 between pieces; first come words carried over from the last shard."""

    def __init__(self, lang: str = "", carried: tuple[bytes, ...] = ()):
        self.numbers = count(1)
        self.known: dict[str, dict[bytes, int]] = {}
        self.parts, self.words, self.bytes = [np.zeros(1, np.int32)], 0, 0
        self.carried = len(carried)
        if carried:
            self.add(lang, list(carried))

    def add(self, lang: str, found: list[bytes]) -> None:
        known = self.known.get(lang)
        if known is None:
            known = self.known[lang] = defaultdict(self.numbers.__next__)
            known[b"."] = 0
        ids = np.fromiter(map(known.__getitem__, found), np.int32, len(found))
        self.parts.append(ids)
        self.words += len(ids)

    def end_piece(self) -> None:
        self.parts.append(np.zeros(1, np.int32))

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        """Rows of words, then one of the index."""
        self.end_piece()
        text, self.parts = np.concatenate(self.parts), []
        text = text[(text != 0) | (np.concatenate(([1], text[:-1])) != 0)]  # no empty pieces
        if not len(text) or not text.any():
            return
        order, before = transform(text)
        # places 1 to carried were in the last shard, too
        early = np.array([np.flatnonzero(order == place)[0] for place in range(1, 1 + self.carried)], np.int32)
        many = np.bincount(text)
        low = np.cumsum(many) - many
        of_shard = number << ROW_BITS
        for lang, known in self.known.items():
            names = [w for w in known if known[w]]
            ids = np.array([known[w] for w in names], np.int64)
            for k in range(0, len(ids), AT_ONCE):
                some = ids[k : k + AT_ONCE]
                less = (np.searchsorted(np.sort(early), low[some] + many[some]) - np.searchsorted(np.sort(early), low[some])).astype(np.int64)
                yield _batch(
                    place=pa.array(of_shard + low[some]), lang=pa.array([lang] * len(some)), size=pa.array(many[some] << 3 | less),
                    word=pa.array([w.decode() for w in names[k : k + AT_ONCE]]),
                )
        packed = pa.compress(before.tobytes(), codec="zstd", asbytes=True)
        yield _batch(
            place=pa.array([of_shard]), rows=pa.array([len(before)], pa.int32()), index=pa.array([packed], pa.binary()),
            early=pa.array([early.tolist()], pa.list_(pa.int32())),
        )


_COLUMNS = {"place": pa.int64(), "lang": pa.string(), "word": pa.string(), "size": pa.int64(), "rows": pa.int32(), "index": pa.binary(), "early": pa.list_(pa.int32())}
_SCHEMA = "place long, lang string, word string, size long, rows int, index binary, early array<int>"


def _batch(**columns: pa.Array) -> pa.RecordBatch:
    n = len(columns["place"])
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in _COLUMNS.items()], list(_COLUMNS))


def shards(docs: DataFrame, text: str, lang: str, shard_words: int, shard_bytes: int, slice_bytes: int) -> DataFrame:
    """Rows of words (place, lang, word, size) and of indexes (place, rows, index, early).

    place: the shard's number, then the first row of the interval.  size: rows of the
    interval times eight, and how many of them were counted in the shard before.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << SHARD_BITS)
        shard = Shard()
        for batch in stream:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                last: list[bytes] = []
                for part in slices(data.as_py() or b"", slice_bytes):
                    if shard.words >= shard_words or shard.bytes >= shard_bytes:
                        yield from shard.batches(next(numbers))
                        shard = Shard(name, tuple(last))
                    found = words(part)
                    shard.add(name, found)
                    shard.bytes += len(part)
                    last = [*last, *found[1 - LONGEST :]][1 - LONGEST :]
                    if b"." in last:
                        last = last[len(last) - last[::-1].index(b".") :]
                shard.end_piece()
        yield from shard.batches(next(numbers))

    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    return map_batches(named, batches, _SCHEMA)


def extended(before: np.ndarray, early: np.ndarray, low: np.ndarray, many: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """From the intervals of frequent phrases of length - 1 words those of ``length`` words whose
    both parts are among them: numbers of the parts, first row, rows, rows counted elsewhere."""
    n = len(before)
    which = np.full(n, -1, np.int32)
    order = np.argsort(low)
    low, many = low[order], many[order]
    inside = np.repeat(low - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
    which[inside] = np.repeat(order, many)
    # the j-th row by the word before it is a step back from the row that j is
    steps = before.astype(np.int64) << 32
    steps |= np.arange(n)
    steps.sort()
    suffix = which[(steps & 0xFFFFFFFF).astype(np.int32)]
    rows = np.flatnonzero((steps >> 32 > 0) & (which >= 0) & (suffix >= 0))
    del steps
    prefix, suffix = which[rows], suffix[rows]
    starts = np.flatnonzero(np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])))) if len(rows) else rows
    first, size = rows[starts], np.diff(starts, append=len(rows))
    # of o words carried over, phrases that end within them were counted before
    gone = np.sort(early[: max(0, len(early) - length + 1)])
    less = np.searchsorted(gone, first + size) - np.searchsorted(gone, first)
    return prefix[starts], suffix[starts], first, size, less


def longer(index: DataFrame, frequent: DataFrame, length: int, parts: int) -> DataFrame:
    """(prefix, suffix, place, size) of each shard's phrases of ``length`` words with frequent parts."""

    def extend(shard: pa.Table, intervals: pa.Table) -> pa.Table:
        names = ["prefix", "suffix", "place", "size"]
        if not len(shard) or not len(intervals):
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        rows = shard.column("rows")[0].as_py()
        packed = shard.column("index")[0].as_py()
        before = np.frombuffer(pa.decompress(packed, rows * 4, codec="zstd", asbytes=True), np.int32)
        early = np.array(shard.column("early")[0].as_py(), np.int64)
        place, size, ids = (intervals.column(c).to_numpy() for c in ("place", "size", "id"))
        low = place & ((1 << ROW_BITS) - 1)
        prefix, suffix, first, many, less = extended(before, early, low, size >> 3, length)
        # rows counted elsewhere stay: with a word more they may not be
        of_shard = place[0] >> ROW_BITS << ROW_BITS
        found = pa.table(dict(zip(names, (ids[prefix], ids[suffix], of_shard + first, many << 3 | less), strict=True)))
        return pa.Table.from_batches(found.to_batches(max_chunksize=AT_ONCE), found.schema)

    shard = F.shiftright("place", ROW_BITS)
    index = index.withColumn("shard", shard).repartition(parts, "shard")
    frequent = frequent.select("place", "size", "id").withColumn("shard", shard).repartition(parts, "shard")
    return index.groupBy("shard").cogroup(frequent.groupBy("shard")).applyInArrow(extend, "prefix long, suffix long, place long, size long")


def summed(found: DataFrame, by: list[str], least: int, name: str) -> DataFrame:
    """The rows of phrases (keyed ``by``) with ``least`` occurrences or more in all shards together,
    with their count f and their name id: the smallest place, which is the phrase's own."""
    of = Window.partitionBy(*by)
    found = found.withColumn("f", F.sum(F.shiftright("size", 3) - F.col("size").bitwiseAND(7)).over(of)).where(F.col("f") >= least)
    return stored(found.withColumn("id", F.min("place").over(of)), name)


def phrases(frequent: DataFrame, shorter: DataFrame) -> DataFrame:
    """One row per phrase: id, lang, phrase, last, f, prefix, suffix, and the counts of its
    beginnings (heads) and ends (tails) by length."""
    own = frequent.where("id = place").select("id", "f", "prefix", "suffix")
    head = shorter.select(F.col("id").alias("prefix"), "lang", "phrase", "heads")
    tail = shorter.select(F.col("id").alias("suffix"), "last", "tails")
    return own.join(head, "prefix").join(tail, "suffix").select(
        "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "f", "prefix", "suffix",
        F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"),
    )


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
    shard_words: int = SHARD_WORDS, shard_bytes: int = SHARD_BYTES, slice_bytes: int = SLICE,
) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are runs of anything but spaces and tabs within pieces, A-Z in lower case.  A null
    text is empty, a null language ``und``; every row counts, repeated ones too.  Phrases
    have 2 to ``LONGEST`` words and a >= ``least`` occurrences.  Other columns are left
    behind; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    ship(spark)
    read = stored(shards(docs, text, lang, shard_words, shard_bytes, slice_bytes), "shards")
    found = read.where("word is not null").select("lang", "word", "place", "size")
    index = read.where("index is not null").select("place", "rows", "index", "early")
    totals = found.groupBy("lang").agg(F.sum(F.shiftright("size", 3) - F.col("size").bitwiseAND(7)).alias("n"))
    totals = stored(totals, "totals")
    parts = max(2 * index.count(), spark.sparkContext.defaultParallelism)

    frequent = summed(found, ["lang", "word"], least, "words")
    level = frequent.where("id = place").select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.array("f").alias("heads"), F.array("f").alias("tails")
    )
    level = stored(level, "phrases")
    levels = []
    for length in range(2, LONGEST + 1):
        frequent = summed(longer(index, frequent, length, parts), ["prefix", "suffix"], least, "frequent")
        level = stored(phrases(frequent, level), "phrases")
        levels.append(level)

    scored = []
    for length, (level, further) in enumerate(zip(levels, [*levels[1:], None]), 2):
        if further is not None:  # a longer phrase as frequent as this one stands one word longer, too
            around = further.select(F.col("prefix").alias("id"), "f").union(further.select("suffix", "f"))
            around = around.groupBy("id").agg(F.max("f").alias("most"))
            level = level.join(around, "id", "left").where("most is null or most < f")
        level = level.join(totals, "lang")
        # products of counts pass 64 bits
        wide = "cast({} as decimal(19, 0))".format
        cuts = F.array_min(F.array(*(
            F.struct(
                F.expr(f"(1000 * {wide('f')} * {wide('n')}) div ({wide(f'heads[{k - 1}]')} * {wide(f'tails[{length - k - 1}]')})").alias("score"),
                F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[length - k - 1].alias("r"),
            )
            for k in range(1, length)
        )))
        scored.append(level.withColumn("cut", cuts).select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score"))
    every = scored[0]
    for one in scored[1:]:
        every = every.union(one)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _sql() -> str:
    counts = "SELECT lang, {} AS phrase, {} AS m, count(*) AS f FROM w WHERE {} GROUP BY ALL"
    grams = []
    for m in range(1, LONGEST + 1):
        parts = ["word", *(f"lead(word, {k}) OVER piece" for k in range(1, m))]
        inner = f"(SELECT lang, {', '.join(f'{p} AS w{k}' for k, p in enumerate(parts))} FROM w WINDOW piece AS (PARTITION BY d, p ORDER BY i))"
        joined = " || ' ' || ".join(f"w{k}" for k in range(m))
        grams.append(counts.format(joined, m, f"w{m - 1} IS NOT NULL").replace("FROM w ", f"FROM {inner} "))
    return f"""
    WITH d AS (
        SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    pieces AS (
        SELECT d, lang, unnest(pieces) AS piece, unnest(range(len(pieces))) AS p
        FROM (SELECT d, lang, regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]') AS pieces FROM d)),
    w AS (
        SELECT d, lang, p, unnest(words) AS word, unnest(range(len(words))) AS i
        FROM (SELECT d, lang, p, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces)),
    f AS MATERIALIZED ({" UNION ALL ".join(grams)}),
    n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
    candidates AS MATERIALIZED (
        SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS words FROM f WHERE m >= 2 AND f >= {LEAST}),
    inside AS (
        SELECT c.lang, array_to_string(c.words[s:s + len - 1], ' ') AS phrase, max(c.a) AS most
        FROM candidates c, range(2, {LONGEST}) AS l(len), range(1, {LONGEST}) AS b(s) WHERE len < m AND s + len - 1 <= m GROUP BY ALL),
    cuts AS (
        SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS score
        FROM candidates c CROSS JOIN range(1, {LONGEST}) AS x(k) JOIN n ON n.lang = c.lang
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
        WHERE k < c.m),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank,
        c.phrase, c.a, c.l, c.r, c.n::BIGINT AS n, c.score::BIGINT AS score
    FROM lowest c LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
    WHERE i.most IS NULL OR i.most < c.a QUALIFY rank <= {TOP}
    """


@query(_sql())
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
