"""The registered queries of the text operators, over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (decontamination, manifest, mixing, pieces, pii, quality_classifier,
                          quality_rules, similarity_join, substring_dedup, suffix_dedup,
                          token_counts, toxicity, whitening)
from tidemark.llm.common import read_documents, read_table


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read_documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(read_documents(spark, sf_dir))
    return quality_rules.judge(entries).drop("n_lines")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = quality_classifier.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir))


def op5_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.similarity_components(read_documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read_documents(spark, sf_dir),
                                      read_table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_documents(spark, sf_dir))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digest(read_documents(spark, sf_dir))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digest(read_documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read_documents(spark, sf_dir))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify(read_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_personal_data, op2_quality_rules, op3_quality_classifier, op4_source_mixing,
        op5_similarity_join, op6_decontamination, op7_toxicity, op8_token_counts,
        op9_substring_dedup, op10_suffix_dedup, op11_embedding_whitening,
        op12_sentencepiece_round_trip, op13_merkle_manifest)}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality_rules.ORACLE_SQL,
    "op4_source_mixing": mixing.oracle_sql(),
    "op5_similarity_join": similarity_join.ORACLE_SQL,
    "op9_substring_dedup": substring_dedup.ORACLE_SQL,
    "op13_merkle_manifest": manifest.ORACLE_SQL,
}
