"""Links between vectors of one label with a cosine of 0.93 or more.

Method: int8 quantised tile products.  The vectors of a label are dealt into blocks, and
every two blocks meet in a tile, so that no task holds more than two blocks however
large the label is.  In a tile the unit vectors are rounded to int8 with a scale each.
With e the length of what rounding took from a vector, the product of two unit vectors
differs from that of their roundings by at most e_a + (1 + e_a) e_b; pairs this bound
leaves possible are recomputed from the originals in double precision.

Equal vectors are one node.  A tile gives a sum of links and one connection for a node,
not its pairs, so that a group of n near copies costs n rows.  The products themselves
are as many as the pairs of a label, by the method.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.llm.common import query, ship, stored, table
from rolehabit.llm.components import components

THRESHOLD = 0.93
#: Vectors of a block.
BLOCK = 1024
#: Pairs recomputed at once.
AT_ONCE = 1 << 17


def usable(vector: str) -> Column:
    """Not null, not zero, every component finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, their scales, and the lengths of the errors."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(unit - codes * scale[:, None], axis=1) + 1e-12


def possible(a: tuple, b: tuple, threshold: float) -> np.ndarray:
    """Which pairs may reach the threshold, as a mask; the tile product of the codes decides."""
    (x, s, e), (y, t, f) = a, b
    exact = np.float32 if 127 * 127 * x.shape[1] < 1 << 24 else np.float64  # sums of whole numbers
    product = (x.astype(exact) @ y.astype(exact).T) * (s[:, None] * t[None])
    return product + (e[:, None] + (1 + e[:, None]) * f[None]) >= threshold - 1e-9


def _tile(rows: pa.Table, threshold: float) -> pa.Table:
    lists = rows.column("vector").combine_chunks()
    vectors = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    nodes, copies, side = (rows.column(c).to_numpy() for c in ("node", "copies", "side"))
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow of squares
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    one = np.flatnonzero(side == 0)
    two = np.flatnonzero(side == 1) if (side == 1).any() or rows.column("apart")[0].as_py() else one
    coded = quantised(unit)
    mask = possible(tuple(c[one] for c in coded), tuple(c[two] for c in coded), threshold)
    if two is one:
        mask = np.triu(mask, 1)
    i, j = np.nonzero(mask)
    i, j = one[i], two[j]
    linked = np.zeros(len(i), bool)
    for k in range(0, len(i), AT_ONCE):
        part = slice(k, k + AT_ONCE)
        linked[part] = np.einsum("ij,ij->i", unit[i[part]], unit[j[part]]) >= threshold
    i, j = i[linked], j[linked]
    links = np.bincount(i, weights=copies[j], minlength=len(nodes)) + np.bincount(j, weights=copies[i], minlength=len(nodes))
    root = np.arange(len(nodes))
    while len(i):
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], least)
        np.minimum.at(root, root[j], least)
        root = root[root]
        if (before == root).all():
            break
    touched = np.flatnonzero(links)
    return pa.table({"node": nodes[touched], "links": links[touched].astype(np.int64), "root": nodes[root[touched]]})


def near_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``rows``: key, n_links, component_id, kept.

    A row links with the others of its label (and number of components) from the
    threshold on; equal vectors always do.  Rows with a null label, or a vector that is
    null, zero or has a null or non-finite component, have no links and are their own
    component; so are rows with a null key, whose component is null and which are kept.
    Repeated rows link with one another.  Other columns are left behind; an empty table
    gives an empty one.
    """
    spark = rows.sparkSession
    ship(spark)
    named = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    takes = usable("vector") & F.col("key").isNotNull() & F.col("label").isNotNull()
    named = named.withColumn("node", F.when(takes, F.xxhash64("label", "vector")))
    nodes = named.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("key").alias("first")
    )
    nodes = stored(nodes.withColumn("size", F.size("vector")), "nodes")
    blocks = nodes.groupBy("label", "size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = nodes.join(blocks, ["label", "size"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tiles = placed.select(
        "label", "size", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), (F.col("block") != F.col("other")).alias("apart"), "node", "copies", "vector",
    )

    def tile(found):
        return _tile(found, threshold)

    found = stored(tiles.groupBy("label", "size", "low", "high").applyInArrow(tile, "node long, links long, root long"), "tiles")
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    # rows that share a key are one component only if they link
    least = nodes.join(groups, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    known = nodes.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(groups.join(least, "component"), "node", "left")
    known = known.select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "first").alias("component_id"))
    linked = named.where("node is not null").select("key", "node").join(known, "node").select("key", "n_links", "component_id")
    alone = named.where("node is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.union(alone).select(
        F.col("key").alias(key), "n_links", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(True)).alias("kept")
    )


@query(
    f"""
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
          AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
        WHERE list_cosine_similarity(a.x, b.x) >= {THRESHOLD}),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links,
        least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id)) AS component_id,
        e.vec_id = least(e.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = e.vec_id), e.vec_id)) AS kept
    FROM embeddings e
    """
)
def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
