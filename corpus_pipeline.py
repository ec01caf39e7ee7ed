"""The training-data pipeline: five operators over ``documents``, one after another.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
All but the last return the columns of ``documents``:

1. quality: rows that the classifier rejects go.
2. near-duplicates: of each group of linked texts the row with the smallest doc_id stays.
3. personal data: findings are replaced by their kinds, and n_chars follows.
4. mixing: sources are drawn to their target weights; a row comes once for each draw.
5. segmentation: every text is encoded as sampled pieces and decoded again.

Rows with a null doc_id are classified, cleaned and mixed like others and are linked with
nothing; of repeated rows with equal doc_id one stays.  Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolehabit.llm import mixing, ngram_join, pii, quality, segmentation
from rolehabit.llm.common import stored, table, unused


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = ngram_join.near_duplicates(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(stored(gone, "gone"), "doc_id", "left_anti").select(*docs.columns)
    # a key that comes more than once: one row of it stays, the one with the least digest
    count, least, digest = (unused(docs, name) for name in ("n", "least", "digest"))
    often = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias(count), F.min(F.xxhash64(*docs.columns)).alias(least))
    often = stored(often.where(F.col(count) > 1), "often")
    if often.isEmpty():
        return kept
    once = F.col(count).isNull()
    kept = kept.withColumn(digest, F.xxhash64(*docs.columns)).join(often, "doc_id", "left").where(once | (F.col(digest) == F.col(least)))
    again = kept.where(~once).dropDuplicates(["doc_id"])
    return kept.where(once).union(again).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, rank, text, ids, log_prob, perturbed, inclusion): text is what the ids decode to."""
    found = segmentation.segmentations(docs, decoding="text")
    return found.select("doc_id", "rank", "text", "ids", "log_prob", "perturbed", "inclusion")


STAGES = [
    ("quality classifier", good),
    ("n-gram Jaccard join", one_of_each),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", segmented),
]

#: A trained network, linked components and sampled draws are beyond SQL; tests hold every
#: stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0])
    return docs
