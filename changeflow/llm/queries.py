"""Registered queries of the corpus operators, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import licenses, merkle
from changeflow.llm.common import scratch_path, table


def op3_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from changeflow.llm.tokenbin import read_tokens, write_tokens

    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path)


def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.toxicity import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op6_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.html import extract

    return extract(table(spark, sf_dir, "pages"))


def op7_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.jaccard import similar_groups

    groups = similar_groups(table(spark, sf_dir, "documents"), shingle_words=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id", "text_class")


def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.substring import deduplicated

    return deduplicated(table(spark, sf_dir, "documents"), window=35)


def op8_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.decontam import find

    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_streaming_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from changeflow.llm.sentencepiece import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")).drop("ids")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.pii import pseudonymized

    rows = pseudonymized(table(spark, sf_dir, "documents"), key="corpus-key-1")
    return rows.select("doc_id", "n_entities", "kinds", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.char_length("text").cast("long").alias("n_chars"))


def op2_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.conversations import damaged, repaired

    return repaired(damaged(table(spark, sf_dir, "conversations")))


def op13_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    from changeflow.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op2_license_join": op2_license_join,
    "op1_surrogates": op1_surrogates,
    "op4_streaming_viterbi": op4_streaming_viterbi,
    "op8_block_max_wand": op8_block_max_wand,
    "op5_recompression": op5_recompression,
    "op7_signature_trees": op7_signature_trees,
    "op6_tree_scoring": op6_tree_scoring,
    "op9_toxicity": op9_toxicity,
    "op10_cross_polytope": op10_cross_polytope,
    "op3_token_planes": op3_token_planes,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vantage_points": op13_vantage_points,
}

ORACLE_SQL: dict[str, str] = {"op2_license_join": licenses.oracle_sql(), "op11_merkle_manifest": merkle.oracle_sql()}
