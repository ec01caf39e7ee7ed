"""Deal documents to shards so that every shard holds the sources in their proportions.

Method: proportional stratified interleaving.  The rows of a source are shuffled by a
seeded digest and ranked; rank r of n rows stands at (r + phase) / n, with a phase of its
own for each source, so that a source is spread evenly however few rows it has.  All rows
in the order of these fractions are cut into shards of equal counts.

No rank needs a source, or the table, in one task.  Rows fall into buckets by the leading
bits of what they are ordered by, about as many as the square root of the table has rows;
a bucket's rows are numbered within it, and running sums over the small table of bucket
counts give each its start.  Rows that are equal in all that is ordered by are one row
with a count until they have their ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolehabit.llm.common import query, stored, table

SHARDS = 8
SEED = 29
#: Buckets are two to the power of half the bits of the row count, within these bounds.
LEAST_BITS, MOST_BITS = 8, 20
#: Bits of the digest that orders a source's rows, and of a phase.
ORDER_BITS, PHASE_BITS = 60, 48

IDENTITY = ["source", "key", "size", "crc", "digest"]


def _number(text: Column, bits: int) -> Column:
    """The leading bits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, bits // 4), 16, 10).cast("long")


def _described(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """The identity of each row but for its digest: what it is ordered and cut by."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(source).cast("string").alias("source"), F.col(key).alias("key"),
        (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("crc"),
    )


def _starts(counts: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """Rows before each bucket: running sums over (by, bucket, n), a bounded number of buckets each.

    Sums go in two steps, over groups of buckets and within them, so that no window has
    more rows than the square root of the buckets.
    """
    counts = counts.withColumn("group", F.shiftright(bucket, MOST_BITS // 2))
    before = F.sum("n").over(Window.partitionBy(*by, "group").orderBy(bucket)) - F.col("n")
    groups = counts.groupBy(*by, "group").agg(F.sum("n").alias("n"))
    groups = groups.select(*by, "group", (F.sum("n").over(Window.partitionBy(*by).orderBy("group")) - F.col("n")).alias("base"))
    counts = counts.withColumn("before", before)
    return counts.join(groups, [*by, "group"]).select(*by, bucket, (F.col("base") + F.col("before")).alias("start"))


def positions(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(IDENTITY, n, copy, shard, slot): one row per row of ``rows`` (IDENTITY).

    n: how many rows have this identity; copy numbers them from 0.  Shards differ by one
    row at most, slots run from 0 within a shard.
    """
    digest = F.concat_ws("/", F.lit(str(SEED)), F.col("key").cast("string"), "crc", "size")
    entries = rows.groupBy(*IDENTITY).agg(F.count("*").alias("n")).withColumn("h", _number(digest, ORDER_BITS))
    # a null source is one of its own; the letter keeps it apart from an empty name
    entries = stored(entries.withColumn("stratum", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))), "entries")
    total = entries.agg(F.sum("n")).first()[0] or 0
    bits = min(max(total.bit_length() // 2, LEAST_BITS), MOST_BITS)

    entries = entries.withColumn("bucket", F.shiftright("h", ORDER_BITS - bits))
    counts = stored(entries.groupBy("stratum", "bucket").agg(F.sum("n").alias("n")), "counts")
    phase = _number(F.concat(F.lit(f"{SEED}/phase/"), "stratum"), PHASE_BITS) / F.lit(float(1 << PHASE_BITS))
    sources = counts.groupBy("stratum").agg(F.sum("n").alias("rows")).withColumn("phase", phase)
    starts = _starts(counts, ["stratum"], "bucket").join(sources, "stratum")
    within = Window.partitionBy("stratum", "bucket").orderBy("h", "key", "crc", "size", "digest")
    ranked = entries.join(starts, ["stratum", "bucket"]).withColumn("rank", F.col("start") + F.sum("n").over(within) - F.col("n"))
    # one row for each copy, by way of runs of 2^16 so that no array is long
    ranked = ranked.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, 16))))
    first = F.shiftleft("run", 16)
    ranked = ranked.withColumn("copy", F.explode(F.sequence(first, F.least(first + (1 << 16) - 1, F.col("n") - 1))))
    fraction = (F.col("rank") + F.col("copy") + F.col("phase")) / F.col("rows")
    ranked = ranked.withColumn("fraction", fraction).withColumn("place", F.floor(F.col("fraction") * (1 << bits)).cast("long"))
    ranked = stored(ranked.select(*IDENTITY, "stratum", "h", "n", "copy", "fraction", "place"), "ranked")

    counts = ranked.groupBy("place").agg(F.count("*").alias("n")).withColumn("all", F.lit(0))
    starts = _starts(counts, ["all"], "place").drop("all")
    within = Window.partitionBy("place").orderBy("fraction", "stratum", "h", "key", "crc", "size", "digest", "copy")
    placed = ranked.join(starts, "place").withColumn("position", F.col("start") + F.row_number().over(within) - 1)
    total = max(total, 1)
    placed = placed.withColumn("shard", F.expr(f"position * {shards} div {total}"))
    slot = F.expr(f"position - (shard * {total} + {shards - 1}) div {shards}")
    return placed.select(*IDENTITY, "n", "copy", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))


def assigned(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: source, key, size (UTF-8 bytes of the text and one),
    text_crc32, shard, slot.

    A null text has no bytes, a null source is a source of its own, a null key sorts
    first; rows that agree in all of these are dealt like others, each to a slot of its
    own.  With more shards than rows the last ones stay empty or hold one row.  Other
    columns are left behind, whatever their names; an empty table gives an empty one.
    """
    placed = positions(_described(docs, key, source, text).withColumn("digest", F.lit(0).cast("long")), shards)
    return placed.select(
        F.col("source"), F.col("key"), "size", F.col("crc").alias("text_crc32"), "shard", "slot"
    ).withColumnsRenamed({"source": source, "key": key})


def sharded(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """Whole rows: the columns of ``docs``, with shard and slot (replaced where they exist).

    Rows are told apart by key, source, text and a digest of all columns a digest can be
    made of (not maps); rows equal in all of them take the places of such a group in any order.
    """
    plain = [f.name for f in docs.schema.fields if '"map"' not in f.json() and '"variant"' not in f.json()]
    digest = F.xxhash64(*(F.col(f"`{c}`") for c in plain))
    described = _described(docs, key, source, text).columns
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), F.col(source).cast("string").alias("source"), F.col(key).alias("key"),
        (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole.cast("binary")).alias("crc"), digest.alias("digest"),
    )
    placed = stored(positions(rows.select(*described, "digest"), shards), "places")

    def same(one: DataFrame, two: DataFrame) -> Column:
        conditions = [one[c].eqNullSafe(two[c]) for c in IDENTITY]
        return conditions[0] & conditions[1] & conditions[2] & conditions[3] & conditions[4]

    once, often = placed.where("n = 1"), placed.where("n > 1")
    out = rows.join(once, same(rows, once)).select("row", "shard", "slot")
    if not often.isEmpty():  # one row stands for all that equal it
        first = often.where("copy = 0")
        one = rows.join(first, same(rows, first), "left_semi").dropDuplicates(IDENTITY)
        out = out.union(one.join(often, same(one, often)).select("row", "shard", "slot"))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in ("shard", "slot")]
    return out.select(*kept, "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, files: int = 1, **columns: str) -> None:
    """Write whole rows by shard, each shard as ``files`` files or so whose rows are in slot order."""
    rows = sharded(docs, shards=shards, **columns)
    rows.repartitionByRange(shards * files, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def _crc_entry(i: int) -> int:
    for _ in range(8):
        i = 0xEDB88320 ^ (i >> 1) if i & 1 else i >> 1
    return i


#: CRC-32 by bytes and the cut of positions, in plain SQL.
_SQL = f"""
    WITH bytes AS (
        SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS b FROM documents),
    sums AS (
        SELECT doc_id, source, b + 1 AS size, xor(4294967295, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(b), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)),
            lambda s, x: xor(s >> 8, ([{", ".join(str(_crc_entry(i)) for i in range(256))}]::BIGINT[])[(xor(s, x) & 255) + 1]))) AS crc FROM bytes),
    ordered AS (
        SELECT *, coalesce('s' || source, '') AS stratum,
            ('0x' || substr(md5(concat_ws('/', '{SEED}', doc_id::VARCHAR, crc::VARCHAR, size::VARCHAR)), 1, {ORDER_BITS // 4}))::BIGINT AS o FROM sums),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY o, doc_id, crc, size) - 1 AS r, count(*) OVER (PARTITION BY stratum) AS rows,
            ('0x' || substr(md5('{SEED}/phase/' || stratum), 1, {PHASE_BITS // 4}))::BIGINT / {float(1 << PHASE_BITS)}::DOUBLE AS phase FROM ordered),
    placed AS (
        SELECT *, row_number() OVER (ORDER BY (r + phase) / rows, stratum, o, doc_id, crc, size, r) - 1 AS p, count(*) OVER () AS n FROM ranked)
    SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, (p * {SHARDS} // n)::INTEGER AS shard,
        p - ((p * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} AS slot, NULL::INTEGER AS grown_shard
    FROM placed
"""


@query(_SQL)
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = assigned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
