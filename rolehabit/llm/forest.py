"""Approximate nearest neighbours by inner product, from a forest of hash prefixes.

Method: a hash-prefix forest.  Each tree gives a vector a string of ``LETTERS`` letters:
a letter names the axis of a random rotation the vector lies nearest to, and its sign.
A tree is the sorted array of these strings.  A query descends in every tree to the
entries with the longest prefix in common, and ascends in all trees at once, letter by
letter, until what is unseen is not likely to be among the nearest, or the root; it is
compared with the vectors of all of them.

When to stop: a vector of cosine c to the query shares a letter with it with probability
p(c), measured for the number of components, and is unseen at prefixes of L letters
with probability (1 - p(c)^L)^TREES.  The true nearest lie no farther than the farthest of
the nearest found, so a query stops where a vector there is unseen with probability ``MISS``
at most.  That holds for tables of any size.

The arrays are cut by tree and first letter, and a cut with many entries or many queries
into chunks, so that no task holds more than a chunk of each.  A first pass counts the
entries by length of common prefix; levels that meet fewer than ``ENOUGH`` are passed over
unsearched.  Then every level is a pass over the queries that have not stopped.  Queries
that must ascend to the root meet all vectors in blocks.
What is passed on for a vector is its int8 codes; the codes' error bound decides what
may be among the nearest, and those few are compared by the original vectors in double
precision.

Largest inner products become nearest directions if every vector gets one more component
that makes all lengths equal (that of the longest), and queries get a zero there.
"""

from __future__ import annotations

from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolehabit.llm.common import map_batches, query, ship, stored, table
from rolehabit.llm.near_vectors import usable

NEAREST, EVERY = 20, 20
TREES, LETTERS, ENOUGH = 48, 3, 2048
#: Probability at most that one of the nearest is unseen where a query stops below the root.
MISS = 0.1
#: Entries and queries of a chunk.
CHUNK, QUERY_CHUNK = 8192, 1024
SEED = 5


@cache
def rotations(size: int) -> np.ndarray:
    """Random rotations of each tree and letter; they depend on the number of components alone."""
    draw = np.random.default_rng(SEED)
    return np.stack([np.linalg.qr(draw.normal(size=(size, size)))[0] for _ in range(TREES * LETTERS)]).astype(np.float32)


def strings(vectors: np.ndarray) -> np.ndarray:
    """Letters of each vector: rows by trees by LETTERS, of 0 to twice the number of components."""
    out = np.empty((len(vectors), TREES * LETTERS), np.int64)
    for k, rotation in enumerate(rotations(vectors.shape[1])):
        turned = vectors @ rotation
        axis = np.abs(turned).argmax(axis=1)
        out[:, k] = 2 * axis + (turned[np.arange(len(vectors)), axis] > 0)
    return out.reshape(len(vectors), TREES, LETTERS)


@cache
def least_cosine(size: int, length: int) -> float:
    """From which cosine on a vector is unseen at prefixes of ``length`` letters with probability ``MISS`` at most."""
    draw = np.random.default_rng(SEED)
    u, w = draw.normal(size=(2, 20_000, size))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-12)
    rows, axis = np.arange(len(u)), np.abs(u).argmax(axis=1)
    wanted = (1 - MISS ** (1 / TREES)) ** (1 / length)
    least = 1.0
    for c in np.linspace(1, 0, 51):  # downwards as far as every cosine shares enough
        v = c * u + np.sqrt(1 - c * c) * w
        same = (np.abs(v).argmax(axis=1) == axis) & (v[rows, axis] * u[rows, axis] > 0)
        if same.mean() < wanted:
            break
        least = float(c)
    return least


def _vectors(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _entries(nodes: DataFrame, size: int, longest: float) -> DataFrame:
    """(tree, letter, rest, node, asks, codes, scale, error): each vector in every tree.

    rest: the letters after the first as one number, so that sorting it sorts the strings.
    """

    def batches(rows):
        for batch in rows:
            if not batch.num_rows:
                continue
            x = _vectors(batch.column("vector"))
            scale = np.abs(x).max(axis=1) / 127
            codes = np.rint(x / scale[:, None]).astype(np.int8)
            error = np.linalg.norm(x - codes * scale[:, None], axis=1) * (1 + 1e-9)
            short = np.sqrt(np.maximum(0, 1 - (np.linalg.norm(x, axis=1) / longest) ** 2))
            as_data = strings(np.column_stack([x / longest, short]).astype(np.float32))
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            as_query = strings(np.column_stack([x / np.abs(x).max(axis=1, keepdims=True), np.zeros(len(x))])[asks].astype(np.float32))
            node = batch.column("node").to_numpy()
            for found, which, is_query in ((as_data, np.arange(len(x)), False), (as_query, np.flatnonzero(asks), True)):
                rest = found[:, :, 1].copy()
                for k in range(2, LETTERS):
                    rest = rest * (2 * (size + 1)) + found[:, :, k]
                n = len(which)
                if not n:
                    continue
                for low in range(0, TREES, 16):
                    part = slice(low, low + 16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.tile(np.arange(TREES, dtype=np.int32)[part], n)), pa.array(found[:, part, 0].reshape(-1).astype(np.int32)),
                         pa.array(rest[:, part].reshape(-1)), pa.array(np.repeat(node[which], 16)), pa.array(np.full(n * 16, is_query)),
                         pa.array(np.repeat(np.array([c.tobytes() for c in codes[which]], object), 16), pa.binary()),
                         pa.array(np.repeat(scale[which], 16)), pa.array(np.repeat(error[which], 16))],
                        ["tree", "letter", "rest", "node", "query", "codes", "scale", "error"],
                    )

    schema = "tree int, letter int, rest long, node long, query boolean, codes binary, scale double, error double"
    return map_batches(nodes.select("node", "asks", "vector"), batches, schema)


def _tiled(entries: DataFrame, *by: str) -> DataFrame:
    """Entries and queries of each cut in chunks, every chunk of the ones with every chunk of the others."""
    sizes = entries.groupBy(*by).agg(
        F.greatest(F.lit(1), F.ceil(F.count_if(~F.col("query")) / CHUNK)).cast("int").alias("parts"),
        F.greatest(F.lit(1), F.ceil(F.count_if("query") / QUERY_CHUNK)).cast("int").alias("query_parts"),
    )
    placed = entries.join(sizes, list(by))
    of = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    placed = placed.withColumn("part", F.explode(F.when(F.col("query"), every("parts")).otherwise(F.array(of("parts")))))
    return placed.withColumn("query_part", F.explode(F.when(F.col("query"), F.array(of("query_parts"))).otherwise(every("query_parts"))))


def _prefix_ranges(strings_sorted: np.ndarray, asked: np.ndarray, length: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the stretch of the sorted array that has its first ``length`` letters."""
    unit = base ** (LETTERS - length)
    low = asked // unit * unit
    return np.searchsorted(strings_sorted, low), np.searchsorted(strings_sorted, low + unit)


def _split(rows: pa.Table):
    asks = rows.column("query").to_numpy()
    return np.flatnonzero(~asks), np.flatnonzero(asks)


def _met(rows: pa.Table, base: int) -> pa.Table:
    """How many entries of a chunk share how many letters at least with each query."""
    rest, node = rows.column("rest").to_numpy(), rows.column("node").to_numpy()
    data, asks = _split(rows)
    order = np.sort(rest[data])
    out = []
    for length in range(1, LETTERS + 1):
        a, b = _prefix_ranges(order, rest[asks], length, base)
        out.append(pa.table({"node": node[asks], "length": pa.array(np.full(len(asks), length, np.int32)), "n": b - a}))
    return pa.concat_tables(out)


def _best(rows: pa.Table, base: int, length: int) -> pa.Table:
    """The entries of a chunk that share ``length`` letters with a query (0: all) and that may be among its nearest."""
    codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.int8).reshape(rows.num_rows, -1).astype(np.float32)
    scale, error, node = (rows.column(c).to_numpy() for c in ("scale", "error", "node"))
    data, asks = _split(rows)
    if length:
        rest = rows.column("rest").to_numpy()
        data = data[np.argsort(rest[data], kind="stable")]
        rest_sorted = rest[data]
    rough = codes[data] * scale[data, None]
    lengths = np.linalg.norm(rough, axis=1)
    queries, found = [], []
    for q in asks:
        low, high = 0, len(data)
        if length:
            low, high = (int(x[0]) for x in _prefix_ranges(rest_sorted, rest[q : q + 1], length, base))
        if low == high:
            continue
        own = codes[q] * scale[q]
        about = rough[low:high].astype(np.float64) @ own.astype(np.float64)
        # |x.y - x'.y'| <= e_x |y| + |x'| e_y, and |y| <= |y'| + e_y
        within = error[data[low:high]] * (np.linalg.norm(own) + error[q]) + lengths[low:high] * error[q] + 1e-5 * (1 + np.abs(about))
        if high - low > NEAREST + 1:  # the query itself may be one of them
            bar = np.partition(about - within, -(NEAREST + 1))[-(NEAREST + 1)]
            hits = np.flatnonzero(about + within >= bar)
        else:
            hits = np.arange(high - low)
        queries.append(np.full(len(hits), node[q]))
        found.append(node[data[low:high][hits]])
    whole = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.table({"query": whole(queries), "node": whole(found)})


def nearest(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY) -> DataFrame:
    """For each row whose key is divisible by ``every`` the nearest others found, by inner product.

    Rows: query_id, rank, vec_id, score; ties go to the smaller key.  Rows with a null key
    or an unusable vector (null, zero, a null or non-finite component) take no part, nor
    do vectors of another number of components than most have (the smaller number, if
    two are as common).  Of repeated rows one takes part, the one with the smallest
    digest.  Other columns are left behind; an empty table gives an empty one.
    """
    ship(rows.sparkSession)
    named = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(F.col("id").isNotNull() & usable("vector"))
    result = "query_id long, rank int, vec_id long, score double"
    common = named.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return rows.sparkSession.createDataFrame([], result)
    size = common.size
    named = stored(named.where(F.size("vector") == size).groupBy("id").agg(F.min_by("vector", F.xxhash64("vector")).alias("vector")), "vectors")
    # equal vectors are one entry; more than NEAREST + 1 of them, the smallest, cannot be among the nearest of one query
    named = named.withColumn("node", F.xxhash64("vector"))
    order = Window.partitionBy("node", "salt").orderBy("id")
    some = named.select("node", "id", F.pmod("id", F.lit(64)).alias("salt")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= NEAREST + 1)
    again = Window.partitionBy("node").orderBy("id")
    members = stored(some.withColumn("place", F.row_number().over(again)).where(F.col("place") <= NEAREST + 1).select("node", "id"), "members")
    nodes = stored(named.groupBy("node").agg(F.first("vector").alias("vector"), F.max((F.pmod("id", F.lit(every)) == 0)).alias("asks")), "nodes")
    longest = nodes.agg(F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]

    base = 2 * (size + 1)
    entries = _entries(nodes, size, longest)
    # the first pass needs no vectors
    counted = _tiled(entries.select("tree", "letter", "rest", "node", "query"), "tree", "letter").groupBy("tree", "letter", "part", "query_part")
    met = counted.applyInArrow(lambda t: _met(t, base), "node long, length int, n long")
    met = met.groupBy("node", "length").agg(F.sum("n").alias("n"))
    waiting = stored(met.groupBy("node").agg(F.coalesce(F.max(F.when(F.col("n") >= ENOUGH, F.col("length"))), F.lit(0)).alias("level")), "levels")

    dot = lambda x, y: F.aggregate(F.arrays_zip(F.col(x).alias("x"), F.col(y).alias("y")), F.lit(0.0), lambda a, z: a + z["x"] * z["y"])
    asked = nodes.where("asks").select(F.col("node").alias("query"), F.col("vector").alias("x"))

    def searched(asking: DataFrame, length: int) -> DataFrame:
        """(query, node, score): the nearest distinct vectors met at prefixes of this length, for the queries asking."""
        some = entries.join(asking.select("node", F.lit(True).alias("asking")), "node", "left").where("not query or asking")
        by = ("tree", "letter") if length else ("all",)
        # the root: all vectors, out of one tree
        some = some if length else some.where("tree = 0").withColumn("all", F.lit(0))
        near = _tiled(some, *by).groupBy(*by, "part", "query_part").applyInArrow(lambda t: _best(t, base, length), "query long, node long")
        scored = stored(near.distinct(), "near").join(asked, "query").join(nodes.select("node", F.col("vector").alias("y")), "node")
        # per distinct query vector: at most what every chunk could not rule out
        ranked = scored.select("query", "node", dot("x", "y").alias("score"))
        ranked = ranked.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).where(F.col("place") <= NEAREST + 1)
        return stored(ranked.select("query", "node", "score"), f"ranked-{length}")

    found = []
    for length in range(LETTERS, 0, -1):
        asking = waiting.where(F.col("level") >= length)
        if asking.isEmpty():
            continue
        ranked = searched(asking, length)
        # the query itself may be one of those found
        last = ranked.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("score")).where(F.col("n") > NEAREST).join(asked, "query")
        near_enough = F.col("score") >= least_cosine(size + 1, length) * longest * F.sqrt(dot("x", "x"))
        stopped = stored(last.where(near_enough).select("query"), "stopped")
        found.append(ranked.join(stopped, "query", "left_semi"))
        waiting = stored(waiting.join(stopped, F.col("node") == F.col("query"), "left_anti"), "waiting")
    if not waiting.isEmpty():
        found.append(searched(waiting, 0))
    ranked = reduce(DataFrame.union, found) if found else nodes.limit(0).select(F.col("node").alias("query"), "node", F.lit(0.0).alias("score"))
    ids = named.where(F.pmod("id", F.lit(every)) == 0).select(F.col("id").alias("query_id"), F.col("node").alias("query"))
    pairs = ids.join(ranked.select("query", "node", "score"), "query").join(members, "node").where("id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return pairs.select("query_id", F.row_number().over(final).alias("rank"), F.col("id").cast("long").alias("vec_id"), "score").where(F.col("rank") <= NEAREST)


@query()
def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
