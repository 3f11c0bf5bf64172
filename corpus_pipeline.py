"""From raw documents to a training mix, stage by stage."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, mixing, pii, quality_classifier, similarity_join
from tidemark.llm.common import read_documents, read_table, small_batches
from tidemark.session import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality reaches the threshold; the rest go."""
    labels = read_table(spark, sf_dir, "labels")
    return quality_classifier.accepted(docs, quality_classifier.train(docs, labels))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared shingles of five words, the one with the smallest id."""
    return similarity_join.one_of_each(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers, plain and disguised, give way to their kind."""
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, once per epoch they are taken in."""
    return mixing.mixed_documents(docs)


def _in_small_batches(stage):
    """A stage that hands texts to Python workers a few megabytes at a time."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [(name, _in_small_batches(stage)) for name, stage in (
    ("quality", keep_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
)]

#: Trained and approximate stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
