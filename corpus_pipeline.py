"""A corpus pipeline over ``documents``: each stage works on all rows that the one before kept.

toxicity: documents that the model rejects go. ngram_join: of each group of near duplicates (five
words, similarity 0.8) the document with the smallest doc_id stays. decontamination: documents with
a benchmark item go. pii: entities are replaced by surrogates. sentencepiece: texts become ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import removed, scratch_owner, scratch_path, table, written
from changeflow.llm.decontam import clean_documents as without_benchmark
from changeflow.llm.jaccard import FEW, similar_groups
from changeflow.llm.pii import pseudonymized_documents
from changeflow.llm.sentencepiece import round_trip
from changeflow.llm.toxicity import clean_documents as without_toxic
from changeflow.llm.toxicity import train

KEY = "corpus-key-1"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a doc_id stay. Of repeated rows one stays; different texts under one doc_id are documents of their own."""
    again = written(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", F.lit(True).alias("_again")), "pipeline-again")
    repeated = not again.isEmpty()
    own = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    keyed = docs.join(_small(again), "doc_id", "left").withColumn("_row", F.when(F.col("_again"), own).otherwise(F.col("doc_id").cast("long")))
    groups = written(similar_groups(keyed.select(F.col("_row").alias("doc_id"), "text"), shingle_words=5, percent=80).select(F.col("doc_id").alias("_row"), "component_id"), "pipeline-groups")
    groups = groups.where("_row is not null").distinct()
    gone = groups.where("_row <> component_id").select("_row")
    if repeated:  # the smallest of a group's row keys need not be that of its smallest doc_id
        named = groups.join(keyed.select("_row", "doc_id").distinct(), "_row")
        first = named.groupBy("component_id").agg(F.min_by("_row", F.struct("doc_id", "_row")).alias("first"))
        gone = named.join(first, "component_id").where("_row <> first").select("_row")
    kept = keyed.join(_small(written(gone, "pipeline-gone")), "_row", "left_anti")
    if repeated:
        kept = kept.where("_again is null").unionByName(kept.where("_again").dropDuplicates(["_row"]))
    return kept.select(*docs.columns)


def _small(rows: DataFrame) -> DataFrame:
    """Broadcast, if counted few."""
    return F.broadcast(rows) if rows.count() <= FEW else rows


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pseudonymized_documents(docs, key=KEY)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentencepiece", sentencepiece),
]

#: A trained model and character paths are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_ids, ids_crc32, n_chars, round_trip`` of the documents that all stages keep.

    A stage's scratch, and the output of the stage before, are removed once its own output is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_owner(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            removed(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
