"""Piece encoding and decoding against the library."""

from collections import Counter
from hashlib import sha256

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces, queries
from tidemark.llm.common import read_documents

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, ids string, n_tokens string"
CODEC = pieces.codec(pieces.model_path())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
VOCABULARY = sorted(CODEC.score)
AWKWARD = [(1, None, "x", "y"), (2, "", "x", "y"), (2, "", "x", "y"), (None, "no id", "x", "y"),
           (4, " ▁ \t\r\n\x00", None, None), (5, "z" * 200_000 + " é\U0001f600 </s><0x41>", "", ""),
           (6, " " * 50_000, "", ""), (7, " ".join(f"w{k}" for k in range(20_000)), "", "")]


def plain(rows):
    out = []
    for doc_id, text, *_ in rows:
        ids = LIBRARY.encode(text or "", add_eos=True)
        out.append((doc_id, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    return Counter(out)


def collected(df):
    return Counter(map(tuple, df.select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))


def test_query_matches_library(spark):
    rows = [(r.doc_id, r.text) for r in read_documents(spark, SF).collect()]
    assert collected(queries.QUERIES["op12_sentencepiece_round_trip"](spark, SF)) == plain(rows)


def test_awkward_texts(spark):
    table = spark.createDataFrame(AWKWARD, SCHEMA)
    assert collected(pieces.round_trip(table)) == plain(AWKWARD)
    encoded = pieces.encode(table)
    assert (Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect())
            == Counter((i, tuple(LIBRARY.encode(t or "", add_eos=True))) for i, t, *_ in AWKWARD))
    assert (Counter(map(tuple, pieces.decode(encoded).collect()))
            == Counter((i, (t or "").replace("▁", " ")) for i, t, *_ in AWKWARD))
    for operator in (pieces.encode, pieces.round_trip):
        assert operator(table.limit(0)).count() == 0
    some = spark.createDataFrame([(1, None), (2, []), (3, [None, 3, 28705])],
                                 "doc_id bigint, ids array<int>")
    assert [r.text for r in pieces.decode(some).sort("doc_id").collect()] == ["", "", "\x00 "]


def same(text):
    ids = LIBRARY.encode(text, add_eos=True)
    assert CODEC.encode(text) == ids and CODEC.decode(ids) == LIBRARY.decode(ids)
    decoded = sha256(LIBRARY.decode(ids).encode()).hexdigest()
    assert CODEC.digest(text)[::2] == (len(ids), decoded)


@settings(max_examples=1500, deadline=None)
@given(st.one_of(
    st.text(max_size=60), st.text("abcdeinorst ▁.,\n'01é", max_size=80),
    st.text("ab=-*#x_/\\(){}; ", max_size=120),
    st.lists(st.sampled_from(VOCABULARY), max_size=9).map(lambda k: "".join(k).replace("▁", " "))))
def test_any_text(text):
    same(text)


@pytest.mark.parametrize("end", ["", "a", "\n", "é", "word"])
def test_runs_of_spaces(end):
    for size in range(120):
        same(" " * size + end)
        same("x" + " " * size + end)


@settings(max_examples=800, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 262), st.just(28705)),
                max_size=9))
def test_any_ids_decode(ids):
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


def test_backtracking_gives_the_merges():
    """Without cutting texts into chunks, and with failed positions to go back from."""
    for text in ("▁the▁cat▁sat", "▁unbelievable▁words▁aaaaaaa", "▁" * 41 + "of▁it", "==-==--=="):
        assert CODEC.split(text) == CODEC.merged(text)
