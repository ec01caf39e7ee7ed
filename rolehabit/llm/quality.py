"""Quality of whole texts by a byte-level convolutional network in numpy.

The text's UTF-8 bytes are cut into overlapping chunks that cover all of it.  In a
chunk, learned filters of ``WIDTH`` bytes slide over every position; beside the bytes
they see how well each block of eight bytes repeats an earlier one at any of the lags
up to ``LAGS`` (a channel computed from the bytes, since no filter of fixed bytes can
see that a word is said again).  Every filter is max-pooled over its chunk, a linear
layer makes one logit of a chunk, and the mean of a document's chunk logits gives its
probability.

The network is trained here, by Adam on the log loss, on at most ``SAMPLE_ROWS``
labelled rows taken in the order of a hash, ``SAMPLE_CHUNKS`` chunks of each.  That is
the only bound; scoring reads every byte of every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.llm.common import map_batches, query, table

CHUNK, STEP = 1024, 960  # bytes; neighbours share 64
WIDTH, FILTERS, LAGS, BLOCK = 5, 8, 48, 8
REPEAT_WIDTH = 12  # blocks that a filter over the repetition channel spans
SAMPLE_ROWS, SAMPLE_CHUNKS = 4000, 3
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.03, 1e-4
#: Chunks worked on at once; bounds a task's memory whatever the texts' lengths.
AT_ONCE = 1024


@dataclass
class Network:
    """tables[j, b, f]: what byte b at place j of filter f adds; out: of the pooled filters."""

    tables: np.ndarray
    bias: np.ndarray
    repeat: np.ndarray  # of the filters over the repetition channel
    repeat_bias: np.ndarray
    out: np.ndarray
    constant: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, self.bias, self.repeat, self.repeat_bias, self.out, self.constant]


def new_network(seed: int = 7) -> Network:
    draw = np.random.default_rng(seed)
    normal = lambda *shape: draw.normal(0, 0.3, shape).astype(np.float32)
    return Network(
        normal(WIDTH, 256, FILTERS), normal(FILTERS), normal(REPEAT_WIDTH, 2) / 4 + np.float32(0.3), normal(2),
        normal(FILTERS + 2), np.zeros(1, np.float32),
    )


def chunked(content: bytes) -> np.ndarray:
    """The chunks of a text, zero-padded; an empty text is one empty chunk."""
    count = 1 + max(0, -(-(len(content) - CHUNK) // STEP))
    padded = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
    padded[: len(content)] = np.frombuffer(content, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


def repetition(chunks: np.ndarray) -> np.ndarray:
    """For each block of eight bytes, the most bytes that equal those at one earlier lag, of 1."""
    ones, best = np.uint64(0x0101010101010101), np.zeros((len(chunks), CHUNK // BLOCK), np.uint64)
    filled = chunks != 0
    for lag in range(2, LAGS + 1):
        same = np.zeros(chunks.shape, np.uint8)
        same[:, lag:] = (chunks[:, lag:] == chunks[:, :-lag]) & filled[:, lag:]
        np.maximum(best, (same.view(np.uint64) * ones) >> np.uint64(56), out=best)
    return best.astype(np.float32) / BLOCK


def forward(net: Network, chunks: np.ndarray, channel: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
    """A logit for each chunk, and what training, which knows the repetition channel, needs besides."""
    places = CHUNK - WIDTH + 1
    peaks = np.empty((len(chunks), FILTERS), np.float32)
    where = np.empty((len(chunks), FILTERS), np.int64)
    for k in range(0, len(chunks), 64):  # a slice fits in the processor's cache
        part = chunks[k : k + 64]
        seen = net.tables[0].take(part[:, :places], axis=0)
        for j in range(1, WIDTH):
            seen += net.tables[j].take(part[:, j : j + places], axis=0)
        if channel is not None:
            where[k : k + 64] = seen.argmax(axis=1)
        peaks[k : k + 64] = seen.max(axis=1)
    peaks += net.bias
    blocks = repetition(chunks) if channel is None else channel
    runs = np.lib.stride_tricks.sliding_window_view(blocks, REPEAT_WIDTH, axis=1)
    second = runs @ net.repeat
    second_where = second.argmax(axis=1)
    second = second.max(axis=1) + net.repeat_bias
    pooled = np.concatenate([peaks, second], axis=1)
    hidden = np.maximum(pooled, 0)
    return hidden @ net.out + net.constant[0], (hidden, pooled, where, runs, second_where)


def _gradients(net: Network, chunks: np.ndarray, channel: np.ndarray, owner: np.ndarray, labels: np.ndarray):
    logits, (hidden, pooled, where, runs, second_where) = forward(net, chunks, channel)
    sizes = np.bincount(owner, minlength=len(labels))
    mean = np.bincount(owner, weights=logits, minlength=len(labels)) / sizes
    error = 1 / (1 + np.exp(-mean)) - labels
    by_chunk = (error / sizes)[owner].astype(np.float32) / len(labels)
    back = by_chunk[:, None] * net.out * (pooled > 0)
    tables = np.zeros_like(net.tables)
    rows, filters = np.arange(len(chunks))[:, None], np.arange(FILTERS)
    for j in range(WIDTH):
        np.add.at(tables[j], (chunks[rows, where + j], np.broadcast_to(filters, where.shape)), back[:, :FILTERS])
    repeat = np.stack([(runs[np.arange(len(runs)), second_where[:, k]] * back[:, FILTERS + k, None]).sum(0) for k in range(2)], 1)
    return [tables, back[:, :FILTERS].sum(0), repeat, back[:, FILTERS:].sum(0), hidden.T @ by_chunk, by_chunk.sum(keepdims=True)]


def train(texts: list[list[bytes]], labels: list[int], seed: int = 7) -> Network:
    """Fit the network to chunks of labelled texts.

    With labels of one kind only, or none, every text gets the constant (n1 + 1) / (n + 2).
    """
    net = new_network(seed)
    y = np.array(labels, np.float64)
    ones = y.sum()
    if ones in (0, len(y)):
        net.out[:] = 0
        net.constant[0] = np.log((ones + 1) / (len(y) - ones + 1))
        return net
    pieces = [np.concatenate([chunked(part) for part in parts]) for parts in texts]
    channels = [repetition(chunks) for chunks in pieces]
    draw = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(y))
        rate = RATE * (1 - epoch / EPOCHS)
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            owner = np.repeat(np.arange(len(rows)), [len(pieces[r]) for r in rows])
            got = _gradients(net, *(np.concatenate([x[r] for r in rows]) for x in (pieces, channels)), owner, y[rows])
            step += 1
            for p, g, m, v in zip(net.parameters(), got, first, second, strict=True):
                g = g + DECAY * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def scores(net: Network, contents: list[bytes]) -> np.ndarray:
    """The probability of each text; long ones are worked on in slices of ``AT_ONCE`` chunks."""
    sums, sizes = np.zeros(len(contents)), np.zeros(len(contents))
    waiting, owners, held = [], [], 0

    def flush():
        nonlocal held
        if held:
            owner = np.concatenate(owners)
            sums[:] += np.bincount(owner, weights=forward(net, np.concatenate(waiting))[0], minlength=len(sums))
            sizes[:] += np.bincount(owner, minlength=len(sums))
        waiting.clear()
        owners.clear()
        held = 0

    for i, content in enumerate(contents):
        chunks = chunked(content)
        for k in range(0, len(chunks), AT_ONCE):
            part = chunks[k : k + AT_ONCE]
            waiting.append(part)
            owners.append(np.full(len(part), i))
            held += len(part)
            if held >= AT_ONCE:
                flush()
    flush()
    return 1 / (1 + np.exp(-sums / np.maximum(sizes, 1)))


def held_out(key: str = "doc_id"):
    """Rows no label is learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Network:
    """Train on a bounded sample: ``SAMPLE_ROWS`` labelled keys, ``SAMPLE_CHUNKS`` places of each text.

    Keys with a null or with contradicting labels teach nothing, nor do null texts.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
        .groupBy(F.col(key).alias("k"))
        .agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .where("low = high")
        .select("k", F.col("low").alias("y"))
        .orderBy(F.xxhash64("k"), "k")
        .limit(SAMPLE_ROWS)
    )
    size = F.greatest(F.length("t") - CHUNK, F.lit(0))
    places = [F.substring(F.col("t"), (F.pmod(F.xxhash64("k", F.lit(i)), size + 1) + 1).cast("int"), F.lit(CHUNK)) for i in range(SAMPLE_CHUNKS)]
    sample = (
        docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
        .join(F.broadcast(known), "k")  # SAMPLE_ROWS rows of two numbers
        .select("k", "y", F.array(*places).alias("parts"))
        .orderBy(F.xxhash64("k"), F.xxhash64("parts"))
        .limit(SAMPLE_ROWS)
        .collect()
    )
    return train([[part.encode() for part in dict.fromkeys(r.parts)] for r in sample], [r.y for r in sample])


def classify(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, score (of label 1), predicted (1 from 0.5 on).

    Null texts are scored as empty ones.  Null keys and repeated rows keep one row each,
    equal texts get equal scores; other columns are left behind; an empty table gives an
    empty one.  One pass without a shuffle; the network is some 60 kB.
    """
    kind = docs.schema[key].dataType.simpleString()

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = scores(net, [(v.as_py() or "").encode() for v in batch.column(1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))],
                [key, "score", "predicted"],
            )

    return map_batches(docs.select(key, text), batches, f"`{key}` {kind}, score double, predicted int")


def keep_good(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, all their columns as they were."""
    at = docs.columns.index(text)

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = scores(net, [(v.as_py() or "").encode() for v in batch.column(at)])
            yield batch.filter(pa.array(found >= 0.5))

    return map_batches(docs, batches, docs.schema)


@query()
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs, table(spark, sf_dir, "labels"))
    return classify(docs, net).select("doc_id", held_out().alias("held_out"), "score", "predicted")
