"""Hard negatives: for each anchor and each of its nearest rows of the same label, the best rows
of other labels whose score comes close to that of the positive.

Method: angular triangle filtering.  Every row keeps its norm and its angles to reference
directions.  The angles p and q of two rows to a direction bound the angle between them by
|p - q| and p + q, so its cosine lies between cos(p + q) and cos(p - q), that is within
cos p cos q - sin p sin q and cos p cos q + sin p sin q.  The directions are at right
angles, and each angle is taken within what the directions before it leave of the row:
so the next direction bounds the last term in the same way, and the interval narrows from
direction to direction.  Multiplied by the norms, and widened by what rounding can do, it
bounds the score.  Only rows whose interval meets what is looked for (the scores of the
best positives, or the windows below them) are scored, in whole numbers.

The directions are the principal ones of a bounded sample, as many as leave ``OUTSIDE`` of
its squared length.  Any others give the same results, slower.

All rows meet the anchors in blocks: a task holds one block of rows, and anchors pass by it
in batches.  Rows are sent once, anchors once for each block they meet; what comes
back is the best ``POSITIVES`` or ``NEGATIVES`` of a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolehabit.llm.common import query, ship, stored, table

SCALE = 256
POSITIVES = NEGATIVES = 5
#: A negative scores at least this percentage of its positive's score, and at most all of it.
PERCENT = 80
#: Components in a block of rows; anchors of a batch; rows the directions are fitted on.
BLOCK, BATCH, SAMPLE = 1 << 20, 128, 4096
#: Share of squared length that the directions may leave.
OUTSIDE = 1 / 16
#: What one stored angle's rounding can do to a cosine, with room to spare.
SLACK = 1e-6
#: Pairs scored at once.
AT_ONCE = 1 << 16
LONGEST = (1 << 63) - 1

DATA = ["node", "id", "label", "codes", "norm", "angles"]
DATA_SCHEMA = "node long, id long, label string, codes array<double>, norm double, angles array<float>"


def coded(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(node, id, label, codes, size): the distinct rows that take part; node tells them apart."""
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("x"))

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf"))

    def floored(x: Column) -> Column:  # beyond 2^52 a double is whole already
        return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)

    rows = rows.where("id is not null and label is not null and x is not null").where(~F.exists("x", odd))
    rows = rows.select("id", "label", F.transform("x", lambda x: floored(x * SCALE)).alias("codes")).distinct()
    return rows.select(F.xxhash64("id", "label", "codes").alias("node"), "*", F.size("codes").alias("size"))


def directions(sample: np.ndarray) -> np.ndarray:
    """Principal directions of the rows, as columns, down to a rest of ``OUTSIDE``."""
    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    share, vectors = np.linalg.eigh(unit.T @ unit)
    share, vectors = np.maximum(share[::-1], 0), vectors[:, ::-1]
    rest = 1 - np.cumsum(share) / max(share.sum(), 1e-300)
    return vectors[:, : int(np.argmax(rest <= OUTSIDE + 1e-12)) + 1]


def axes(size: int) -> np.ndarray:
    """Directions for rows of a size that was not fitted: coordinates."""
    return np.eye(size)[:, : max(1, int(np.ceil(size * (1 - OUTSIDE))))]


def exact_below(size: int) -> float:
    """Codes smaller than this have products that doubles add without error."""
    return float(np.floor(np.sqrt((1 << 53) / max(size, 1))))


def angles_to(codes: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to each direction within what those before it leave.

    A norm of infinity marks a row with codes too large for the filter; it is never passed over.
    """
    largest = np.abs(codes).max(axis=1, initial=0)
    large = largest >= exact_below(codes.shape[1])
    bare = np.where(large[:, None], 0, codes)
    norms = np.linalg.norm(bare, axis=1)
    seen = bare @ references / np.where(norms > 0, norms, 1)[:, None]
    left = np.sqrt(np.maximum(1 - np.cumsum(seen**2, axis=1), 0))
    before = np.concatenate((np.ones((len(codes), 1)), left[:, :-1]), axis=1)
    cosines = np.divide(seen, before, out=np.zeros_like(seen), where=before > 0)
    return np.where(large, np.inf, norms), np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


class Vectors:
    """Rows of one size: what the filter needs of them, and their codes."""

    def __init__(self, rows: pa.Table):
        self.node, self.id = (rows.column(c).to_numpy() for c in ("node", "id"))
        self.label = np.array(rows.column("label").to_pylist(), object)
        angles, codes = (self._matrix(rows.column(c)) for c in ("angles", "codes"))
        norm = rows.column("norm").to_numpy()
        self.codes, self.large = codes, np.isinf(norm)
        self.norm = np.where(self.large, 0, norm)
        left = np.cumprod(np.sin(angles), axis=1)
        before = np.concatenate((np.ones((len(left), 1)), left[:, :-1]), axis=1)
        self.seen = before * np.cos(angles) * self.norm[:, None]
        self.rest = (left[:, -1] if left.shape[1] else np.ones(len(left))) * self.norm

    @staticmethod
    def _matrix(column: pa.ChunkedArray) -> np.ndarray:
        lists = column.combine_chunks()
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(lists), len(flat) // max(len(lists), 1))

    def bounds(self, others: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scores with each of the others.

        Unrolled, the nested intervals are the products of what each direction sees, and
        on either side the product of what all of them leave.
        """
        middle = self.seen @ others.seen.T
        width = np.outer(self.rest, others.rest) + SLACK * (self.seen.shape[1] + 1) * np.outer(self.norm, others.norm)
        least, greatest = middle - width, middle + width
        if self.large.any() or others.large.any():
            unknown = self.large[:, None] | others.large[None]
            least[unknown], greatest[unknown] = -np.inf, np.inf
        return least, greatest

    def scores(self, others: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Inner products of the pairs, as whole numbers; past 64 bits the last of them."""
        out = np.empty(len(i), np.int64)
        for k in range(0, len(i), AT_ONCE):
            part = slice(k, k + AT_ONCE)
            large = self.large[i[part]] | others.large[j[part]]
            products = np.einsum("ij,ij->i", self.codes[i[part]], others.codes[j[part]])
            out[part] = np.where(large, 0, products).astype(np.int64)
            for n in np.flatnonzero(large) + k:
                whole = sum(int(a) * int(b) for a, b in zip(self.codes[i[n]], others.codes[j[n]], strict=True))
                out[n] = max(-LONGEST, min(LONGEST, whole))
        return out


def _best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, nodes: np.ndarray, many: int) -> np.ndarray:
    """Places of the first ``many`` of each group, by score, then id."""
    order = np.lexsort((nodes, ids, -score, group))
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
    return order[place < many]


def _least_of_best(least: np.ndarray, many: int) -> np.ndarray:
    """A score that ``many`` rows reach for sure, for each anchor."""
    if len(least) < many:
        return np.full(least.shape[1], -np.inf)
    return np.partition(least, len(least) - many, axis=0)[len(least) - many]


def best_positives(rows: Vectors, anchors: Vectors, _: pa.Table) -> pa.Table:
    """Rows and anchors of one label: each anchor's best rows other than itself."""
    least, greatest = rows.bounds(anchors)
    # one more than asked for, as the anchor itself may be among the rows
    i, j = np.nonzero(greatest >= _least_of_best(least, POSITIVES + 1))
    other = rows.node[i] != anchors.node[j]
    i, j = i[other], j[other]
    score = rows.scores(anchors, i, j)
    best = _best(j, score, rows.id[i], rows.node[i], POSITIVES)
    return pa.table({"node": anchors.node[j[best]], "other": rows.node[i[best]], "other_id": rows.id[i[best]], "score": score[best]})


FOUND = "node long, other long, other_id long, score long"


def window(positive: int) -> int:
    """The least score a negative may have."""
    return -((-PERCENT * positive) // 100)


def best_negatives(rows: Vectors, anchors: Vectors, table: pa.Table) -> pa.Table:
    """Each anchor's best rows of other labels within the window of each of its positives."""
    least, greatest = rows.bounds(anchors)
    names, code = np.unique(rows.label, return_inverse=True)
    known = {name: n for n, name in enumerate(names)}
    apart = code[:, None] != np.array([known.get(x, -1) for x in anchors.label])[None]
    windows = [w.as_py() for w in table.column("positives")]
    wanted, low, high = np.zeros(least.shape, bool), [], []
    for k in range(POSITIVES):
        tops = [w[k] if k < len(w) else -1 for w in windows]  # a window below zero is empty
        low.append([window(t) if t >= 0 else 0 for t in tops])
        high.append(tops)
        bottom, top = (np.array(x, np.float64) for x in (low[k], tops))
        room = 1 + 1e-9 * top  # for whole numbers that no double holds
        sure = np.where((least >= bottom + room) & (greatest <= top - room) & apart, least, -np.inf)
        bottom = np.maximum(bottom - room, _least_of_best(sure, NEGATIVES))
        wanted |= (greatest >= bottom) & (least <= top + room) & apart & (top >= 0)
    i, j = np.nonzero(wanted)
    score = rows.scores(anchors, i, j)
    parts = []
    for k in range(POSITIVES):
        low_k, high_k = np.array(low[k], np.int64)[j], np.array(high[k], np.int64)[j]
        inside = np.flatnonzero((score >= low_k) & (score <= high_k) & (high_k >= 0))
        best = inside[_best(j[inside], score[inside], rows.id[i[inside]], rows.node[i[inside]], NEGATIVES)]
        parts.append(pa.table({
            "node": anchors.node[j[best]], "place": pa.array(np.full(len(best), k), pa.int32()), "other": rows.node[i[best]],
            "other_id": rows.id[i[best]], "score": score[best],
        }))
    return pa.concat_tables(parts)


FOUND_FOR = "node long, place int, other long, other_id long, score long"


def meeting(
    rows: DataFrame, anchors: DataFrame, block: list[str], parts: int, found: Callable[[Vectors, Vectors, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """What ``found`` finds where the rows of a block meet the anchors sent to it.

    Rows come first in a block and are held; anchors follow in batches.
    """

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, waiting, queued, vectors = None, [], [], 0, None

        def answers() -> Iterator[pa.RecordBatch]:
            nonlocal vectors, waiting, queued
            if held and waiting:
                vectors = vectors or Vectors(pa.Table.from_batches(held))
                asked = pa.Table.from_batches(waiting)
                for k in range(0, len(asked), BATCH):
                    part = asked.slice(k, BATCH)
                    yield from found(vectors, Vectors(part), part).to_batches()
            waiting, queued = [], 0

        for batch in stream:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*block, "asks")), strict=True))
            edges = [0, *(n for n in range(1, len(keys)) if keys[n] != keys[n - 1]), len(keys)]
            for start, stop in zip(edges, edges[1:]):
                if start == stop:
                    continue
                *of, asks = keys[start]
                if of != current:
                    yield from answers()
                    current, held, vectors = of, [], None
                part = batch.slice(start, stop - start)
                if not asks:
                    held.append(part)
                    continue
                waiting.append(part)
                queued += len(part)
                if queued >= BATCH:
                    yield from answers()
        yield from answers()

    both = rows.withColumn("asks", F.lit(0)).unionByName(anchors.withColumn("asks", F.lit(1)), allowMissingColumns=True)
    both = both.repartition(parts, *block).sortWithinPartitions(*block, "asks")
    return both.mapInArrow(batches, schema)


def described(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """The rows with norm and angles."""
    fitted: dict[int, np.ndarray] = {}
    if sizes:
        size = max(sizes, key=lambda s: (sizes[s], s))
        some = rows.where(F.col("size") == size).where(F.pmod("node", F.lit(sizes[size])) < SAMPLE)
        sample = np.array([r.codes for r in some.select("codes").limit(2 * SAMPLE).collect()], np.float64).reshape(-1, size)
        sample = sample[(np.abs(sample) < exact_below(size)).all(axis=1)]
        if size and len(sample):
            fitted[size] = directions(sample)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lists = batch.column(batch.schema.get_field_index("codes"))
            lengths, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
            starts = np.concatenate(([0], np.cumsum(lengths)))
            norms, angles = np.zeros(len(lengths)), [None] * len(lengths)
            for length in np.unique(lengths):
                places = np.flatnonzero(lengths == length)
                codes = flat[starts[places][:, None] + np.arange(length)]
                norms[places], found = angles_to(codes, fitted.get(length, axes(length)))
                for place, row in zip(places, found, strict=True):
                    angles[place] = row
            kept = [batch.column(batch.schema.get_field_index(c)) for c in (*DATA[:4], "size")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(norms), pa.array(angles, pa.list_(pa.float32()))], [*DATA[:4], "size", "norm", "angles"])

    return rows.select(*DATA[:4], "size").mapInArrow(batches, DATA_SCHEMA.replace("norm", "size int, norm"))


def hard_negatives(rows: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """For each anchor and positive the best negatives: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    ``anchor`` says of a row's key, as column ``id``, whether it is an anchor.  Components
    are floored after multiplication by ``SCALE``.  A score is the inner product of two
    rows of equally many components; others never meet.  Rows with a null key or label, a
    null vector, or a component that is null or not finite (after multiplication, too)
    take no part.  Repeated rows of one key, label and codes are one row; rows that share a
    key only are rows of their own.  Higher scores come first, ties by smaller key.  Scores
    past 64 bits count as the last number of 64 bits.  An anchor without positives, a
    positive below zero and one without negatives in its window give no rows.  Other
    columns are left behind; an empty table gives an empty one.
    """
    ship(rows.sparkSession)
    named = stored(coded(rows, key, vector, label), "codes")
    counts = {r.size: r["n"] for r in named.groupBy("size").agg(F.count("*").alias("n")).collect()}  # one row for each number of components
    data = stored(described(named, counts), "angles")
    of_block = F.greatest(F.lit(64), F.lit(BLOCK) / F.greatest(F.lit(1), "size"))  # rows
    least = rows.sparkSession.sparkContext.defaultParallelism
    asked = data.where(anchor)

    # positives: blocks of one label
    blocks = data.groupBy("size", "label").agg(F.ceil(F.count("*") / F.first(of_block)).cast("int").alias("blocks"))
    blocks = stored(blocks, "blocks")
    parts = max(least, blocks.agg(F.sum("blocks")).first()[0] or 0)
    placed = data.join(blocks, ["size", "label"]).withColumn("block", F.pmod("node", "blocks").cast("int")).drop("blocks")
    sent = asked.join(blocks, ["size", "label"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    found = meeting(placed, sent, ["size", "label", "block"], min(parts, 1 << 16), best_positives, FOUND)
    first = Window.partitionBy("node").orderBy(F.desc("score"), "other_id", "other")
    positives = found.withColumn("place", F.row_number().over(first) - 1).where(f"place < {POSITIVES}")
    positives = stored(positives.select("node", "place", "other_id", "score"), "positives")

    # negatives: blocks of all labels, anchors with the scores of their positives
    tops = positives.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("p"))  # POSITIVES entries at most
    tops = tops.select("node", F.transform("p", lambda x: x["score"]).alias("positives"))
    blocks = data.groupBy("size").agg(F.ceil(F.count("*") / F.first(of_block)).cast("int").alias("blocks"))
    blocks = stored(blocks, "blocks")
    parts = max(least, blocks.agg(F.sum("blocks")).first()[0] or 0)
    placed = data.join(blocks, "size").withColumn("block", F.pmod("node", "blocks").cast("int")).drop("blocks")
    sent = asked.join(tops, "node").join(blocks, "size").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    found = meeting(placed, sent, ["size", "block"], min(parts, 1 << 16), best_negatives, FOUND_FOR)
    first = Window.partitionBy("node", "place").orderBy(F.desc("score"), "other_id", "other")
    negatives = found.withColumn("rank", F.row_number().over(first)).where(f"rank <= {NEGATIVES}")

    positives = positives.select("node", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = asked.select("node", F.col("id").alias("anchor_id"))
    out = negatives.join(positives, ["node", "place"]).join(named, "node")
    return out.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


@query(
    f"""
    WITH v AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS c
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.c, b.c)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.c) = len(b.c) WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
    SELECT p.anchor_id, p.vec_id AS positive_id,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
        n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
        AND {PERCENT} * p.score <= 100 * n.score AND n.score <= p.score
    QUALIFY rank <= {NEGATIVES}
    """
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return hard_negatives(rows, F.col("id") % 100 == 0)
