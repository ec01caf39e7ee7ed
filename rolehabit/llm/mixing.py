"""Mix sources to target weights, by exact quotas of blocks.

Method: a multivariate-hypergeometric splitting tree.  A source's documents are dealt by
hash into blocks of about equal size.  Its quota is a number of block draws: every block
as often as the target holds the whole source, and for the rest as many blocks, in a
permuted order, as it takes, the last of them in part.  The quotas of all sources are the
root of a tree whose every node gives exactly half of its draws to each child; how many
of them come from which source is drawn from an urn, without replacement.  The leaves are
the output shards.  Each shard is dealt its number of draws from the permuted list of
each source, no draw twice, and its rows are put in a random order within it.

Columns only: the tree holds counts, an urn is an ``aggregate`` over them, and documents
meet a table of blocks.  All draws are hashes of a seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rolehabit.llm.common import query, stored, table

WHITE = " \t\n\x0b\x0c\r"
WEIGHTS = (1, 2, 3)
REPEATS = 3
#: Words of a block at least; there are about ``BLOCKS`` of them at most, whatever the corpus.
BLOCK_WORDS, BLOCKS = 1 << 16, 1 << 18
SHARD_WORDS = 1 << 19
SEED = 11


def words_in(text: str) -> Column:
    """The number of runs of anything but ASCII white space; 0 for null."""
    bare = F.btrim(F.col(text), F.lit(WHITE))
    return F.when(bare.isNull() | (bare == ""), F.lit(0)).otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).cast("long")


def _named(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """What decides about a row, beside its own columns: source (never null), size, hash (of the text where the key is null)."""
    return docs.withColumns({
        "__source": F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("")),
        "__size": words_in(text),
        "__hash": F.xxhash64(F.lit(SEED), F.col(key), F.when(F.col(key).isNull(), F.col(text))),
    })


def targets(sizes: DataFrame) -> DataFrame:
    """(__source, source_size, target): weights in turn by code point, null last; each at most
    ``REPEATS`` times its source, the excess shared among the others by weight."""
    totals = sizes.groupBy("__source").agg(F.sum("__size").alias("source_size"))
    order = Window.orderBy((F.col("__source") == "").cast("int"), F.col("__source"))  # one row per source
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (place + 1).cast("int")))
    weighed = weighed.withColumn("most", REPEATS * F.col("source_size")).withColumn("all", F.sum("source_size").over(Window.partitionBy()))
    # sources fill up in this order as the level rises; the first that does not sets the level
    fill = Window.orderBy(F.col("most") / F.col("weight"), "__source")
    level = (F.col("all") - F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("weight").over(
        fill.rowsBetween(0, Window.unboundedFollowing)
    )
    weighed = weighed.withColumn("level", level)
    open_level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(Window.partitionBy())
    target = F.least(F.col("most").cast("double"), F.coalesce(open_level * F.col("weight"), F.col("most")).cast("double"))
    return weighed.select("__source", "source_size", target.alias("target"))


def _urn(counts: Column, node: Column) -> Column:
    """How many of each source go to the left child: half of all draws, rounded up."""
    whole = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
    first = F.struct(whole.alias("rest"), F.ceil(whole / 2).cast("long").alias("open"), F.array().cast("array<long>").alias("out"))

    def of_source(state: Column, entry: Column) -> Column:
        count, place = entry["count"], entry["place"]
        draws = F.when(count > 0, F.sequence(F.lit(1).cast("long"), count)).otherwise(F.array().cast("array<long>"))
        begin = F.struct(state["rest"].alias("rest"), state["open"].alias("open"))

        def draw(urn: Column, i: Column) -> Column:
            goes = F.pmod(F.xxhash64(F.lit(SEED), F.lit("tree"), node, place, i), urn["rest"]) < urn["open"]
            return F.struct((urn["rest"] - 1).alias("rest"), (urn["open"] - goes.cast("long")).alias("open"))

        after = F.aggregate(draws, begin, draw)
        taken = state["open"] - after["open"]
        return F.struct((state["rest"] - count).alias("rest"), (state["open"] - taken).alias("open"), F.concat(state["out"], F.array(taken)).alias("out"))

    entries = F.transform(counts, lambda c, i: F.struct(c.alias("count"), i.alias("place")))
    return F.aggregate(entries, first, of_source, lambda s: s["out"])


def shard_quotas(quotas: DataFrame, depth: int) -> DataFrame:
    """(__source, shard, start, stop): which places of a source's list of draws each shard gets.

    quotas: (__source, draws).  Shards differ by one draw a level at most.
    """
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("__source", "draws"))).alias("q")).select(  # one entry per source
        F.lit(1).cast("long").alias("node"), F.transform("q", lambda x: x["__source"]).alias("names"), F.transform("q", lambda x: x["draws"]).alias("counts")
    )
    for _ in range(depth):
        split = nodes.withColumn("left", _urn(F.col("counts"), F.col("node")))
        right = F.zip_with("counts", "left", lambda a, b: a - b)
        children = F.array(F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("counts")), F.struct((2 * F.col("node") + 1).alias("node"), right.alias("counts")))
        nodes = split.select("names", F.explode(children).alias("child")).select("child.node", "names", "child.counts")
    leaves = nodes.select((F.col("node") - (1 << depth)).cast("int").alias("shard"), F.explode(F.arrays_zip("names", "counts")).alias("x"))
    leaves = leaves.select(F.col("x.names").alias("__source"), "shard", F.col("x.counts").alias("n"))
    stop = F.sum("n").over(Window.partitionBy("__source").orderBy("shard"))
    return leaves.select("__source", "shard", (stop - F.col("n")).alias("start"), stop.alias("stop")).where("start < stop")


def plan(sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From rows (__source, __size, __hash): the table of sources and that of blocks.

    sources: __source, source_size, target, blocks.  blocks: __source, block, shards (of
    its draws, in turn; the last one of them counts in part where last_hash is not null,
    for hashes up to it).
    """
    goal = stored(targets(sizes), "targets")
    total = goal.agg(F.sum("source_size")).first()[0] or 0
    block_words = max(BLOCK_WORDS, total // BLOCKS)
    sources = goal.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"))
    sources = sources.withColumn("times", F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("int"))
    sources = stored(sources.withColumn("rest", F.col("target") - F.col("times") * F.col("source_size")), "sources")

    placed = sizes.join(sources.select("__source", "blocks", "times", "rest"), "__source").withColumn("block", F.pmod("__hash", "blocks"))
    permuted = Window.partitionBy("__source").orderBy(F.xxhash64(F.lit(SEED), F.lit("block"), "__source", "block"), "block")
    blocks = placed.groupBy("__source", "block").agg(F.sum("__size").alias("words"), F.first("times").alias("times"), F.first("rest").alias("rest"))
    blocks = blocks.withColumn("before", F.sum("words").over(permuted) - F.col("words"))
    blocks = blocks.withColumn("need", F.col("rest") - F.col("before")).withColumn("more", (F.col("need") > 0) & (F.col("words") > 0))
    blocks = stored(blocks.withColumn("partly", F.col("more") & (F.col("need") < F.col("words"))), "blocks")

    # at most one block of a source is taken in part: its documents up to a hash, to the nearest word count
    cut = blocks.where("partly").select("__source", "block", "need")
    parts = placed.select("__source", "block", "__hash", "__size").join(cut, ["__source", "block"])
    parts = parts.groupBy("__source", "block", "need", "__hash").agg(F.sum("__size").alias("words"))
    middle = F.sum("words").over(Window.partitionBy("__source", "block").orderBy("__hash")) - F.col("words") / 2
    last = parts.withColumn("middle", middle).groupBy("__source", "block").agg(
        F.coalesce(F.max(F.when(F.col("middle") <= F.col("need"), F.col("__hash"))), F.lit(-(1 << 63))).alias("last_hash")
    )

    draws = blocks.select("__source", "block", F.explode(F.sequence(F.lit(0), F.col("times") + F.col("more").cast("int"))).alias("time"), "times", "more")
    draws = draws.where(F.col("time") < F.col("times") + F.col("more").cast("int"))
    dealt = Window.partitionBy("__source").orderBy("time", F.xxhash64(F.lit(SEED), F.lit("draw"), "__source", "block", "time"), "block")
    draws = stored(draws.select("__source", "block", "time", (F.row_number().over(dealt) - 1).cast("long").alias("place")), "draws")
    count = draws.count()
    depth = min(max(0, total // SHARD_WORDS).bit_length(), max(0, count - 1).bit_length())
    quotas = shard_quotas(draws.groupBy("__source").agg(F.count("*").alias("draws")), depth)
    quotas = quotas.select("__source", "shard", F.explode(F.sequence("start", F.col("stop") - 1)).alias("place"))
    shards = draws.join(quotas, ["__source", "place"]).groupBy("__source", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("time", "shard"))), lambda x: x["shard"]).alias("shards")  # REPEATS entries at most
    )
    shards = shards.join(last, ["__source", "block"], "left")
    return sources.select("__source", "source_size", "target", "blocks"), stored(shards, "shards")


def _decided(named: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each row with source_size, target and the shards of its copies; no row is lost or moved."""
    named = named.join(sources.withColumnsRenamed({c: f"__{c}" for c in ("source_size", "target", "blocks")}), "__source", "left")
    named = named.withColumn("__block", F.pmod("__hash", "__blocks"))
    blocks = blocks.select("__source", F.col("block").alias("__block"), F.col("shards").alias("__shards"), F.col("last_hash").alias("__last"))
    named = named.join(blocks, ["__source", "__block"], "left")
    whole = F.col("__last").isNull() | (F.col("__hash") <= F.col("__last"))
    kept = F.when(whole, F.col("__shards")).otherwise(F.slice("__shards", F.lit(1), F.size("__shards") - 1))
    return named.withColumn("__shards", F.coalesce(kept, F.array().cast("array<int>")))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, source_size, target, copies, shards.

    shards: where each copy of the row goes.  A null source is a source, sorted last; a
    null text has no words.  Rows of one key are drawn alike, so repeated rows are taken
    equally often; those of no key are drawn by their texts.  Other columns are left behind; an empty table gives an empty one.
    """
    sizes = stored(_named(docs, key, source, text).select(F.col(key).alias("__key"), "__source", "__size", "__hash"), "sizes")
    sources, blocks = plan(sizes)
    decided = _decided(sizes, sources, blocks)
    return decided.select(
        F.col("__key").alias(key), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.size("__shards").alias("copies"), F.col("__shards").alias("shards"),
    )


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shard: str | None = None) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each copy, shard by shard in random order.

    ``shard`` names a column to add for the shard.
    """
    named = _named(docs, key, source, text)
    sizes = stored(named.select("__source", "__size", "__hash"), "sizes")
    sources, blocks = plan(sizes)
    rows = _decided(named, sources, blocks)
    rows = rows.select(*docs.columns, "__hash", F.posexplode("__shards").alias("__time", "__shard"))
    order = F.xxhash64(F.lit(SEED), F.lit("row"), "__hash", "__time")
    rows = rows.repartition("__shard").sortWithinPartitions("__shard", order)
    return rows.select(*docs.columns, *([F.col("__shard").alias(shard)] if shard else []))


@query()
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "shards")
