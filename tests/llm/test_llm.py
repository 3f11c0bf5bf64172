"""The text operators against plain versions, on small and on awkward tables."""

import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import plain_text as brute
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tidemark.llm import (components, decontamination, mixing, pii, quality_classifier,
                          quality_rules, queries, similarity_join, substring_dedup, suffix_dedup,
                          token_counts, toxicity)
from tidemark.llm.common import read_documents, read_table

SF = "/root/testdata/sf0.01"
TINY = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, hash string"
LONG = " ".join(f"w{k * k % 977}" for k in range(4000))
PASSAGE = " ".join(f"shared{k}" for k in range(60))
#: Nulls everywhere, empty and blank texts, equal rows, ties, a long text, a clashing column.
AWKWARD = [
    (1, "one two three four five six", "en", "src1", 1, "x"),
    (2, None, None, None, None, None), (3, "", "en", "src1", 0, "x"),
    (4, " \t\n ", "de", "nowhere", 4, None), (5, LONG, "en", "src2", 1, "x"),
    (6, LONG + " end", "en", "src2", 1, "x"), (6, LONG + " end", "en", "src2", 1, "x"),
    (None, "no id at all", "en", "src3", 1, "x"),
    (8, PASSAGE + " a@b.example", "en", "src3", 1, "x"),
    (9, "start " + PASSAGE, "fr", "s", 1, "x"), (10, "x" * 5000, "en", "src4", 1, "x"),
    (11, "é​\U0001f600 <|endoftext|> \x1c", "en", "a", 1, "x"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return read_documents(spark, SF).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    assert (Counter(map(tuple, got.select(*names).collect()))
            == Counter(want.select(", ".join(names)).fetchall()))


@settings(max_examples=300, deadline=None)
@given(st.text("a01256789..@@- +(é_%", max_size=60))
def test_plain_spans(text):
    assert [tuple(s) for s in pii.plain_spans(text)] == brute.plain_spans(text)


@pytest.mark.parametrize("text, kind, covered", [
    ("mail john dot doe at example dot com now", "email", "john dot doe at example dot com"),
    ("j.doe [at] mail (dot) example.org x", "email", "j.doe [at] mail (dot) example.org"),
    ("call plus one five five five, one two three four five six", "phone",
     "plus one five five five, one two three four five six"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("１２７.0.0.1", "ip", "１２７.0.0.1")])
def test_disguises_map_back(text, kind, covered):
    plain, spans = pii.find_spans(text)
    assert [(s.kind, text[s.start:s.end]) for s in spans] == [(kind, covered)] and not plain


@pytest.mark.parametrize("kind, disguise", [
    ("email", "john [at] example dot com"), ("email", "john (at) example dot com"),
    ("email", "john at example [dot] com"), ("email", "john.doe at example (dot) com"),
    ("email", "john {dot} doe at mail dot example <dot> com"), ("email", "john@example dot com"),
    ("email", "john (arroba) example punto com"),
    ("ip", "192 dot 168 dot 1 dot 20"), ("ip", "192 [dot] 168 dot 1.20"),
    ("ip", "one two seven [dot] zero [dot] zero [dot] one"),
    ("ip", "one two seven dot 0 dot zero dot one"), ("ip", "un deux sept point zéro point 0 point une"),
    ("phone", "plus zéro six un deux trois quatre cinq six sept huit")])
def test_mixed_disguises(kind, disguise):
    text = f"see, {disguise}, today"
    plain, spans = pii.find_spans(text)
    assert [(s.kind, text[s.start:s.end]) for s in spans] == [(kind, disguise)] and not plain
    assert pii.masked(text, spans) == f"see, <{kind}>, today"


def test_prose_is_left_alone(rows):
    assert not pii.find_spans("meet at noon. At the dot we part, one by one")[1]
    mail = "to a@b.example, now"
    assert pii.masked(mail, pii.find_spans(mail)[1]) == "to <email>, now"
    for _, text in rows:
        plain, spans = pii.find_spans(text)
        assert spans == plain and [tuple(s) for s in plain] == brute.plain_spans(text)


def test_token_counts_match_library(docs, awkward, rows):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(token_counts.vocabulary_path())
    for table, texts in ((docs, rows), (awkward, [r[:2] for r in AWKWARD])):
        want = Counter((i, len((t or "").encode()),
                        len(library.encode(t or "", add_special_tokens=False).ids))
                       for i, t in texts)
        got = token_counts.count_tokens(table).select("doc_id", "n_bytes", "n_tokens").collect()
        assert Counter(map(tuple, got)) == want


def test_dedups_match_plain_versions(docs, awkward, rows):
    for table, plain in ((docs, rows), (awkward, [r[:2] for r in AWKWARD])):
        got = substring_dedup.dedup_digest(table).select("doc_id", "n_words", "n_removed",
                                                         "kept_sha256")
        assert Counter(map(tuple, got.collect())) == brute.word_dedup(plain)
        got = suffix_dedup.dedup_digest(table).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                      "kept_sha256")
        assert Counter(map(tuple, got.collect())) == brute.byte_dedup(plain)


def test_dedups_of_different_texts_under_one_id(spark):
    """Several texts that share a passage, without an id and with the same one."""
    plain = [(k, f"only{n} " * (3 + 400 * (n == 2)) + f"{PASSAGE} tail{n}")
             for k in (None, 7) for n in range(3)] + [(9, "short"), (9, PASSAGE)]
    # Texts of one id are in the order of their hashes.
    table = spark.createDataFrame(plain, "doc_id bigint, text string")
    order = {r.text: r.th for r in substring_dedup.keyed(table).collect()}
    plain.sort(key=lambda r: order[r[1]])
    got = substring_dedup.dedup_digest(table).select("doc_id", "n_words", "n_removed",
                                                     "kept_sha256")
    assert Counter(map(tuple, got.collect())) == brute.word_dedup(plain)
    got = suffix_dedup.dedup_digest(table).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                  "kept_sha256")
    assert Counter(map(tuple, got.collect())) == brute.byte_dedup(plain)


@pytest.mark.parametrize("size, letters", [(1, 2), (7, 2), (400, 2), (400, 3), (2000, 50)])
@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_suffixes_are_sorted(size, letters, limit):
    text = np.r_[np.random.default_rng(size).integers(1, letters, size), 0].astype(np.uint16)
    parts = suffix_dedup.sorted_suffixes(text, 64, 10 ** 6, suffix_dedup.Store(limit))
    assert ([int(k) for part in parts for k in part]
            == sorted(range(size), key=lambda k: text[k:].tolist()))


def test_similarity_join_matches_plain_version(docs, rows):
    got = similarity_join.similarity_components(docs).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.components(rows)


def test_similarity_join_of_awkward_rows(awkward):
    got = {(r[0], r[2]) for r in similarity_join.similarity_components(awkward).collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (None, None), (8, 8), (9, 8),
                   (10, 10), (11, 11)}


@pytest.mark.parametrize("block", [similarity_join.BLOCK, 16])
def test_a_group_whose_members_are_not_all_linked(spark, monkeypatch, block):
    """Near copies of one text that differ from each other more than from it, in some chains."""
    monkeypatch.setattr(similarity_join, "BLOCK", block)
    rng = np.random.default_rng(17)
    plain = []
    for k in range(140):
        words = [f"t{w}" for w in range(90)]
        for at in rng.integers(0, 90, rng.integers(1, 6)):
            words[at] = f"x{rng.integers(0, 400)}"
        plain.append((k, " ".join(words)))
    table = spark.createDataFrame(plain, "doc_id bigint, text string")
    got = similarity_join.similarity_components(table).collect()
    want = brute.components(plain)
    assert {r[0]: (r[1], r[2]) for r in got} == want
    assert 1 < len({c for _, c in want.values()}) < len(plain)


def test_tree_finds_all_points_in_reach():
    points = np.random.default_rng(3).poisson(6, (900, 32))
    sizes = points.sum(axis=1)
    tree = similarity_join.CountTree(points, sizes)
    for k in range(0, 900, 50):
        overlap = np.minimum(points, points[k]).sum(axis=1)
        want = set(np.flatnonzero(170 * overlap >= 70 * (sizes + sizes[k])))
        assert want <= set(tree.search(points[k], sizes[k], 70))


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 120)]
    got = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r[0]: r[1] for r in got} == {**{k: 0 for k in range(21)},
                                         **{k: 100 for k in range(100, 120)}}


def test_leaks_match_contained_items(spark, docs, rows):
    items = read_table(spark, SF, "benchmark")
    want = {(d, i.item_id) for i in items.collect() for d, t in rows if i.text in t}
    found = decontamination.find_leaks(docs, items).collect()
    assert want <= {(r.doc_id, r.item_id) for r in found} and len(found) <= 1.05 * len(want)


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


def test_leaks_match_longest_common_subsequences(spark, rows):
    """Several hundred items of mixed length, given whole and with words changed or put in."""
    rng = np.random.default_rng(23)
    pool = [w for _, t in rows[:300] for w in re.findall("[a-z]+", t or "")]
    items, texts = [], []
    for k in range(320):
        at, size = rng.integers(0, len(pool) - 70), rng.integers(4, 61)
        items.append(pool[at:at + size])
    for k in range(40):
        at = rng.integers(0, len(pool) - 200)
        text = pool[at:at + 120]
        for item in items[8 * k:8 * k + 8]:
            copy = [*item]
            for n in range(rng.integers(0, len(item) // 4 + 1) if k % 2 else 0):
                place = rng.integers(0, len(copy))
                copy[place:place + rng.integers(0, 2)] = ["other"]
            place = rng.integers(0, len(text))
            text = [*text, *copy] if k % 4 == 3 else text[:place] + copy + text[place:]
        texts.append(text)
    want = set()
    for i, item in enumerate(items):
        step = decontamination.piece_words(len(item))
        for d, text in enumerate(texts):
            held = Counter(item)
            for at in range(0, len(text), step):
                window = text[at:at + 4 * step]
                if sum((held & Counter(window)).values()) < 0.6 * len(item):
                    continue
                share = plain_common(item, window) / len(item)
                # Without a sentence the whole item is its answer.
                if share >= 0.75:
                    want.add((d, i))
    got = decontamination.find_leaks(
        spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)],
                              "doc_id bigint, text string"),
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)],
                              "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 250


@pytest.mark.parametrize("size", [3, 60])
def test_widely_leaked_items_are_found(spark, size):
    """An item in most documents makes its own words frequent; another has frequent words only."""
    item, common = "seven grey herons crossed the frozen lake at dawn", "the of and to in a"
    texts = [f"n{k} m{k} " + (item if k % 3 else common) + " end" for k in range(size)]
    got = decontamination.find_leaks(
        spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string"),
        spark.createDataFrame([(1, item), (2, common)], "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(k, 1 if k % 3 else 2) for k in range(size)}
    assert all(r.cosine > 0.9 for r in got)


def test_common_subsequence():
    a, b = np.array([1, 2, 3, 4, 5, 3], np.uint64), np.array([2, 9, 4, 3, 3], np.uint64)
    assert decontamination.common_subsequence(a, b) == 3


def test_ablations_match_counts(docs):
    entries = quality_rules.ledger(docs)
    bits = [r.failed_bits for r in entries.collect()]
    for r in quality_rules.ablations(entries).collect():
        own = 1 << r.bit
        assert r.failing == sum(bool(b & own) for b in bits)
        assert r.failing_only_this == sum(b == own for b in bits)
        assert r.kept_without == sum(not b & ~own for b in bits)


@pytest.mark.parametrize("operator, column, least", [(quality_classifier, "quality", 0.97),
                                                     (toxicity, "toxic", 0.7)])
def test_classifiers_on_held_out_rows(spark, docs, operator, column, least):
    labels = read_table(spark, SF, "labels")
    got = operator.score(docs, operator.train(docs, labels)).join(labels, "doc_id").toPandas()
    assert (got.held_out == [crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    ranks, positive = held.score.rank(), held[column] == 1
    area = ((ranks[positive].sum() - positive.sum() * (positive.sum() + 1) / 2)
            / (positive.sum() * (~positive).sum()))
    assert area > least


def test_awkward_and_empty_tables(spark, awkward):
    labels, train = read_table(spark, TINY, "labels"), read_documents(spark, TINY)
    items = spark.createDataFrame([(1, PASSAGE), (2, None), (3, "")],
                                  "item_id bigint, text string")
    quality, toxic = quality_classifier.train(train, labels), toxicity.train(train, labels)
    empty = awkward.limit(0)
    for run in (pii.detect, pii.mask, quality_rules.ledger,
                lambda d: quality_classifier.score(d, quality),
                lambda d: toxicity.score(d, toxic)):
        assert run(awkward).count() == len(AWKWARD)
        assert run(empty).count() == 0
    for run in (mixing.mix, substring_dedup.dedup, suffix_dedup.dedup,
                similarity_join.similarity_components,
                lambda d: decontamination.find_leaks(d, items)):
        run(awkward).collect()
        assert run(empty).count() == 0
    assert {r.doc_id for r in decontamination.find_leaks(awkward, items).collect()} == {8, 9}
    none = quality_classifier.train(train, labels.limit(0))
    assert {r.score for r in quality_classifier.score(awkward, none).collect()} == {0.5}


@pytest.mark.parametrize("known", ["false", "quality = 0"])
def test_quality_keeps_all_documents_without_both_classes(spark, known):
    train, labels = read_documents(spark, TINY), read_table(spark, TINY, "labels").where(known)
    kept = quality_classifier.accepted(train, quality_classifier.train(train, labels))
    assert kept.columns == train.columns
    assert (Counter(r.doc_id for r in kept.collect())
            == Counter(r.doc_id for r in train.collect()))


def test_pipeline_keeps_its_promises(spark):
    raw = docs = read_documents(spark, TINY)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TINY)
        assert docs.columns == raw.columns
    assert 0 < docs.count() < raw.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, TINY)
    assert {"domain", "epoch"} <= set(out.columns) and out.count() > 0
