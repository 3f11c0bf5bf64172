"""Whitening against a local computation, and on awkward tables."""

import numpy as np
import pytest

from tidemark.llm import queries, whitening
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id bigint, embedding array<float>, component string, n string"


def plain(vectors):
    """n, deviations and whitened coordinates by numpy on one machine."""
    whole = np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(whole), whole.sum(0)
    centred = (n * whole - sums) / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1][:32], turned[:, ::-1][:, :32]
    total = np.trace(centred.T @ centred / n)
    return (n, np.square(n * whole - sums).sum(1), centred @ (turned / np.sqrt(values)),
            values / total)


def compare(rows, ids, vectors):
    n, deviation, whitened, explained = plain(vectors)
    kept = len(explained)
    assert len(rows) == n * kept and {r["n"] for r in rows} == {n}
    got = {(r["vec_id"], r["component"]): r for r in rows}
    table = np.array([[got[i, k + 1]["whitened"] for k in range(kept)] for i in ids])
    signs = np.sign((table * whitened).sum(0))
    assert np.abs(table * signs - whitened).max() < 1e-9
    assert [got[i, 1]["deviation"] for i in ids] == deviation.tolist()
    assert np.allclose([got[ids[0], k + 1]["explained"] for k in range(kept)], explained)
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-9


def test_query_matches_local_computation(spark):
    source = read_table(spark, SF, "embeddings").collect()
    rows = queries.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    compare(rows, [r["vec_id"] for r in source], [r["embedding"] for r in source])


@pytest.mark.parametrize("rows_a_block, blocks_a_task", [(3, 1), (7, 2), (1, 16)])
def test_many_blocks(spark, monkeypatch, rows_a_block, blocks_a_task):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", blocks_a_task)
    random = np.random.default_rng(3)
    vectors = (random.normal(size=(61, 5)) * [9, 4, 2, 1, .5]).astype(np.float32)
    ids = [(-1) ** k * (k << 40) - k for k in range(61)]
    table = spark.createDataFrame(
        [(i, v, "x", None) for i, v in zip(ids, vectors.tolist())], SCHEMA).repartition(3)
    compare(whitening.whiten(table).collect(), ids, vectors)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a", None), (1, [1.0, 2.0], "a", None), (None, [3.0, -1.0], None, "b"),
            (4, [0.5, 7.0], "x", "y"), (5, None, "x", "y"), (6, [1.0, None], "x", "y"),
            (7, [nan, 1.0], "x", "y"), (8, [1.0, -inf], "x", "y"), (9, [], "x", "y"),
            (10, [1.0, 2.0, 3.0], "x", "y")]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r["vec_id"] or -1), r["component"]) for r in out) == [
        (-1, 1), (-1, 2), (1, 1), (1, 1), (1, 2), (1, 2), (4, 1), (4, 2)]
    _, deviation, whitened, _ = plain([[1, 2], [1, 2], [3, -1], [.5, 7]])
    of_null = [r for r in out if r["vec_id"] is None]
    assert {r["deviation"] for r in of_null} == {deviation[2]}
    assert np.allclose(sorted(abs(r["whitened"]) for r in of_null), sorted(abs(whitened[2])))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, [1.0, 2.0], "a", None)],
                                  [(k, [1.0, 2.0], "a", None) for k in range(5)]])
def test_no_spread_gives_no_rows(spark, rows):
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert out.collect() == [] and out.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_directions_without_spread_are_left_out(spark):
    rows = [(k, [float(k), 2.0 * k, 5.0], "a", None) for k in range(6)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in out} == {1} and len(out) == 6
    assert out[0]["explained"] == pytest.approx(1) and out[0]["identity_error"] < 1e-9
