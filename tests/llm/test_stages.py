"""Stages and queries on empty tables and on tables whose columns are named like their own."""

from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import (decontamination, pii, quality_classifier, quality_rules, token_counts,
                          toxicity)
from tidemark.llm.common import read_documents, read_table

TINY = "/root/testdata/sf0.001"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, "
          "th string, score string, label string, component string, cosine string, hash string")
LEAK = "seven grey herons crossed the frozen lake at dawn"
ROWS = [(i, text, lang, "src1", 3, *(f"{name}{k}" for name in "abcdefg"))
        for k, (i, text, lang) in enumerate([
            (1, f"first {LEAK} last", "en"), (2, "write to joe@site.org today", None),
            (2, "write to joe@site.org today", None), (None, None, None), (4, "", "de"),
            (5, "nothing to see here", "fr"), (None, f"and {LEAK} too", "en")])]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_columns_and_rows_stay(spark, table):
    labels = read_table(spark, TINY, "labels")
    model = quality_classifier.train(read_documents(spark, TINY), labels)
    items = spark.createDataFrame([(1, LEAK), (2, None), (3, "")], "item_id bigint, text string")
    for stage in (pii.mask, lambda d: decontamination.without_leaks(d, items),
                  lambda d: quality_classifier.accepted(d, model, keep_from=0.0)):
        out = stage(table)
        assert out.columns == table.columns
        assert {tuple(r)[5:] for r in out.collect()} <= {r[5:] for r in ROWS}
        assert stage(table.limit(0)).collect() == []
    masked = Counter((r.doc_id, r.text) for r in pii.mask(table).collect())
    assert masked[2, "write to <email> today"] == 2 and sum(masked.values()) == len(ROWS)
    clean = decontamination.without_leaks(table, items).collect()
    assert all(LEAK not in (r.text or "") for r in clean) and {5, 4, 2} <= {r.doc_id for r in clean}
    assert quality_classifier.accepted(table, model, keep_from=0.0).count() == len(ROWS)


def test_empty_tables_give_no_rows(spark, table):
    empty = table.limit(0)
    entries = quality_rules.ledger(empty)
    assert token_counts.count_tokens(empty).collect() == []
    assert quality_rules.judge(entries).collect() == []
    assert all(r.failing == 0 for r in quality_rules.ablations(entries).collect())


@pytest.mark.parametrize("operator, column", [(quality_classifier, "quality"),
                                              (toxicity, "toxic")])
def test_repeated_ids_and_labels(spark, operator, column):
    """Rows of an id may repeat, in documents and in labels, and change no more than weights."""
    docs, labels = read_documents(spark, TINY), read_table(spark, TINY, "labels")
    twice = operator.train(docs.unionByName(docs.limit(20)), labels.unionByName(labels))
    scores = operator.score(docs, twice).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)


def test_stages_hand_texts_to_workers_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    docs = spark.range(0, 12, 1, 1).selectExpr(
        "id as doc_id", "repeat('x', 1 << 20) as text", "'s' as source", "'en' as lang",
        "cast(1 << 20 as bigint) as n_chars")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for _, stage in corpus_pipeline.STAGES[3:]:
            spark.conf.set(name, "64m")
            stage(spark, docs, "")
            found = [r["size"] for r in docs.mapInArrow(sizes, "size bigint").collect()]
            assert sum(found) > 12 << 20 and max(found) < 6 << 20
        spark.conf.set(name, "1m")                     # a session's smaller bound stays
        corpus_pipeline.STAGES[3][1](spark, docs, "")
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, before)
