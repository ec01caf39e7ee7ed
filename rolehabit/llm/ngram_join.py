"""Links between texts whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

Method: adaptive multi-match prefixes.  Shingles get a total order, roughly from rare
to frequent.  A text of n shingles that may link with another shares at least
t = ceil(0.8 n) of them, so for every m its first n - t + m shingles and those of the
other share at least m.  Each text lengthens its prefix to the m with the least
estimated cost, and a pair is verified only if it shares as many prefix shingles as the
smaller of its two m.

The order comes from a table of ``BUCKETS`` counts over all shingles of all texts (its
size is fixed); as any total order gives the same links, its errors cost time only.

Groups of copies stay cheap.  Texts with equal sets are one node.  Each node is first
verified against one node only, the most central that shares most of its prefix with
it; the rest of a group is then connected and need not be compared within.  After that,
pairs are made only where a shingle occurs in several components, so no link between
different texts that could join two of them is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolehabit.llm.common import map_batches, query, stored, table
from rolehabit.llm.components import components

WORDS = 5
PERCENT = 80
BUCKETS, SLICES = 1 << 20, 256
MATCHES = (1, 2, 4, 8, 16, 32)
#: Classes whose parity is kept of each set, 64 to a column.
PARITIES = 512
ODD = [f"odd_{i}" for i in range(PARITIES // 64)]
#: Sets remembered by a task so as to pass each on once.
REMEMBERED = 1 << 18

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit digests of a text's distinct 5-word shingles; fewer words make one of all."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashed = np.array([digest(w) for w in words], np.uint64)
    if len(words) < WORDS:
        return np.array([digest(hashed.tobytes(), 1)], np.uint64)
    mixed = np.zeros(len(hashed) - WORDS + 1, np.uint64)
    for k in range(WORDS):
        mixed = (mixed ^ hashed[k : k + len(mixed)]) * _MIX[k]
        mixed ^= mixed >> np.uint64(29)
    mixed.sort()
    return mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))]


def node_of(found: np.ndarray) -> int:
    """A set's identity: a signed 64-bit digest."""
    return xxhash.xxh3_64_intdigest(found.tobytes()) - (1 << 63)


def buckets(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - 20)).astype(np.int64)


def read_sets(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, np.ndarray]:
    """Rows (key, n, node) and the counts of all shingles by bucket, from one pass."""
    kind = docs.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)

        def out(keys, sizes, nodes, slices, sums):
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(slices, pa.int32()), pa.array(sums, pa.binary())],
                ["key", "n", "node", "slice", "counts"],
            )

        key_type = None
        for batch in rows:
            key_type = batch.column(0).type
            sets = [shingles(v.as_py()) for v in batch.column(1)]
            if sets:
                np.add.at(counts, buckets(np.concatenate(sets)), 1)
            nothing = [None] * len(sets)
            yield out(batch.column(0), [len(s) for s in sets], [node_of(s) for s in sets], nothing, nothing)
        if key_type is not None:
            nothing = [None] * SLICES
            parts = [c.tobytes() for c in np.split(counts, SLICES)]
            yield out(pa.nulls(SLICES, key_type), nothing, nothing, list(range(SLICES)), parts)

    read = map_batches(docs.select(key, text), batches, f"key {kind}, n long, node long, slice int, counts binary")
    read = stored(read.withColumn("part", F.spark_partition_id()), "sets")

    def summed(rows):
        total = np.sum([np.frombuffer(c.as_py(), np.int64) for c in rows.column("counts")], axis=0)
        return pa.table({"slice": rows.column("slice")[:1].cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    # a slice is 32 kB; at most 256 of them meet in the first step
    first = read.where("slice is not null").groupBy("slice", (F.col("part") / 256).cast("int").alias("some")).applyInArrow(summed, "slice int, counts binary")
    total = np.zeros(BUCKETS, np.int64)
    for row in first.groupBy("slice").applyInArrow(summed, "slice int, counts binary").collect():  # BUCKETS numbers
        total[row.slice * (BUCKETS // SLICES) :][: BUCKETS // SLICES] = np.frombuffer(row.counts, np.int64)
    return read.where("slice is null").select("key", "n", "node"), total


def matches_wanted(excess: np.ndarray, n: int) -> int:
    """The number of shared prefix shingles to ask for, by estimated cost.

    ``excess``: for the shingles of the longest prefix, in order, how many other texts
    are likely to have each.  Longer prefixes cost their lists, shorter ones the
    verification of candidates, each of which costs about n.
    """
    need = -(-PERCENT * n // 100)
    best, wanted = None, 1
    sums = np.cumsum(excess)
    for m in MATCHES:
        length = n - need + m
        if m > need or length > len(sums):
            break
        lists = sums[length - 1]
        cost = lists + 1.0 * length + n * lists / (m * m)
        if best is None or cost < best:
            best, wanted = cost, m
    return wanted


def parities(found: np.ndarray) -> bytes:
    """For each of ``PARITIES`` classes of shingles whether the set has an odd number of them.

    Where two sets differ in a class by parity they differ in a shingle at least, so the
    number of such classes is a lower bound of the size of their symmetric difference.
    """
    odd = np.bincount((found & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def prefixes(docs: DataFrame, text: str, counts: np.ndarray) -> DataFrame:
    """(node, n, wanted, tokens, odd): each distinct set's prefix and parities, once per task at most."""
    rank = np.empty(BUCKETS, np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(BUCKETS, dtype=np.uint64)
    excess = (np.maximum(counts - np.median(counts), 0) + 0.1).astype(np.float32)
    ordering = docs.sparkSession.sparkContext.broadcast((rank.astype(np.uint32), excess))  # BUCKETS pairs of numbers

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, excess = ordering.value
        seen: set[int] = set()
        for batch in rows:
            nodes, sizes, wanted, tokens, odd = [], [], [], [], []
            for value in batch.column(0):
                found = shingles(value.as_py())
                n = len(found)
                if not n or (node := node_of(found)) in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(node)
                place = buckets(found)
                # rank first; equal ranks stay in order of the digest
                order = np.argsort(rank[place], kind="stable")
                need = -(-PERCENT * n // 100)
                order = order[: n - need + MATCHES[-1]]
                m = matches_wanted(excess[place[order]], n)
                nodes.append(node)
                sizes.append(n)
                wanted.append(m)
                tokens.append(found[order[: n - need + m]].view(np.int64))
                odd.append(np.frombuffer(parities(found), np.int64))
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(wanted, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), *(pa.array([o[i] for o in odd], pa.int64()) for i in range(len(ODD)))],
                ["node", "n", "wanted", "tokens", *ODD],
            )

    return map_batches(docs.select(text), batches, f"node long, n long, wanted int, tokens array<long>, {', '.join(f'{c} long' for c in ODD)}")


#: Pairs of one centre that are compared in one go.
TOGETHER = 256


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose similarity is high enough, by their whole sets.

    Texts travel, which take less than their sets: that of a once for each pair, that of
    the centre b once for up to ``TOGETHER`` pairs or so.  A task holds one centre's set.
    """
    of_centre = Window.partitionBy("b")
    dealt = pairs.withColumn("salts", F.ceil(F.count("*").over(of_centre) / TOGETHER).cast("int"))
    dealt = stored(dealt.withColumn("salt", F.pmod(F.xxhash64("a"), "salts").cast("int")).drop("salts"), "dealt")
    members = dealt.select(F.col("a").alias("node"), F.col("b").alias("centre"), "salt", F.lit(1).alias("role"))
    centres = dealt.select(F.col("b").alias("node"), F.col("b").alias("centre"), "salt", F.lit(0).alias("role")).distinct()
    asked = members.union(centres).join(nodes.select("node", F.col("first").alias("k")), "node")
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(asked, "k").select("centre", "salt", "role", "node", "t")
    texts = texts.repartition("centre", "salt").sortWithinPartitions("centre", "salt", "role")

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, x = None, np.empty(0, np.uint64)
        for batch in rows:
            a, b = [], []
            for centre, role, node, value in zip(*(batch.column(c) for c in ("centre", "role", "node", "t")), strict=True):
                centre, node, y = centre.as_py(), node.as_py(), shingles(value.as_py())
                if node_of(y) != node:  # two rows may have one key but different texts
                    continue
                if not role.as_py():
                    held, x = centre, y
                elif held == centre:
                    both = np.concatenate((x, y))
                    both.sort()
                    shared = int((both[1:] == both[:-1]).sum())
                    if 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                        a.append(node)
                        b.append(centre)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_batches(texts, compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id.

    component_id is the smallest key reachable by links.  Texts that are null, empty or
    white space have no shingles and are linked with nothing.  Rows with a null key
    are linked with nothing either and get a null component.  Rows that share a key are
    linked through it as well as through their texts.  Other columns are left behind;
    an empty table gives an empty one.  Two sets are taken as equal if a 64-bit digest
    of them is.
    """
    rows, counts = read_sets(docs, key, text)
    nodes = stored(
        rows.where("n > 0 and key is not null").groupBy("node").agg(F.min("key").alias("first"), F.max("n").alias("n")), "nodes"
    )
    prefixed = stored(prefixes(docs.where(F.col(key).isNotNull()), text, counts), "prefixes")
    # one exchange of narrow rows by token; what follows has only shingles that two sets have
    of_token, of_node = Window.partitionBy("token"), Window.partitionBy("node")
    tokens = prefixed.select("node", F.explode("tokens").alias("token")).withColumns(
        {"low": F.min("node").over(of_token), "high": F.max("node").over(of_token), "many": F.count("*").over(of_token)}
    )
    shared = tokens.where("low <> high").select("token", "node", "many").distinct()
    sizes = prefixed.select("node", F.col("n").cast("int").alias("n"), "wanted").distinct()
    # central sets share most of their whole prefix
    width = F.col("n") - F.ceil(F.lit(PERCENT) * F.col("n") / 100) + F.col("wanted")
    lists = shared.join(sizes, "node").withColumn("central", F.sum("many").over(of_node) / width)
    lists = stored(lists.drop("many"), "lists")

    # a shingle's leader is the most central set of its own: what copies were made from
    leader = F.max(F.struct("central", "node")).over(of_token)["node"]
    stars = (
        lists.withColumn("leader", leader).where("node <> leader")
        .groupBy(F.col("node").alias("a"), "leader")
        .agg(F.count("*").alias("c"), F.max("n").alias("n"))
        .where(F.col("c") * 4 * 100 >= F.col("n") * (100 - PERCENT))
        .groupBy("a").agg(F.max_by("leader", F.struct("c", "leader")).alias("b"))
    )
    near = verified(stored(stars, "stars"), docs, nodes, key, text)
    near = stored(near, "near")
    grouped = components(near)

    known = prefixed.select("node", *ODD).distinct().join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stored(lists.drop("central").join(known, "node"), "placed")
    split = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    placed = placed.join(split, "token", "left_semi")
    other = placed.select("token", *(F.col(c).alias(f"{c}_2") for c in ("node", "n", "wanted", "component", *ODD)))
    # linked sets differ in at most a ninth of their sizes' sum: s shared of a + b - s are 80 % from s = 4 (a + b) / 9 on
    differ = reduce(add, (F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_2"))) for c in ODD))
    pairs = (
        placed.join(other, "token")
        .where("node < node_2 and component <> component_2")
        .where(f"100 * least(n, n_2) >= {PERCENT} * greatest(n, n_2)")
        .where(differ * (100 + PERCENT) <= (F.col("n") + F.col("n_2")) * (100 - PERCENT))
        .groupBy(F.col("node").alias("a"), F.col("node_2").alias("b"))
        .agg(F.count("*").alias("c"), F.max(F.least("wanted", "wanted_2")).alias("w"))
        .where("c >= w")
        .select("a", "b")
    )
    far = verified(stored(pairs, "pairs"), docs, nodes, key, text)
    # rows that share a key
    same = rows.where("n > 0 and key is not null").groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    many = rows.where("n > 0").join(same.select("key", F.col("a").alias("b")), "key").select(F.col("node").alias("a"), "b")
    whole = components(near.union(far).union(many))
    named = nodes.join(whole, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    named = whole.join(named, "component").select("node", "component_id")
    named = nodes.join(named, "node", "left").select("node", F.coalesce("component_id", "first").alias("component_id"))
    linked = rows.where("n > 0 and key is not null").join(named, "node").select("key", "n", "component_id")
    alone = rows.where("n = 0 or key is null").select("key", "n", F.col("key").alias("component_id"))
    return linked.union(alone).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")


@query()
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
