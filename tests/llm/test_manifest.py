"""The Merkle manifest against a plain tree, its log places, and awkward tables."""

from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import manifest, queries
from tidemark.llm.common import read_documents

SF = "/root/testdata/sf0.01"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "leaf string, tree string, path string")
AWKWARD = [(1, "one", "en", "s", 3, "x", "y", "z"), (1, "one", "en", "s", 3, "x", "y", "z"),
           (1, "another", "en", "s", 3, "x", "y", "z"), (None, "no id", "en", None, 1, "", "", ""),
           (None, None, None, None, None, None, None, None), (5, "", "", "", 0, "", "", ""),
           (6, "é\U0001f600" * 9, "de", "s", 2 ** 63 - 1, "", "", ""), (7, "a:-", "é", "-", -1, "", "", ""),
           *((k, "x" * 50_000 * (k == 13), "fr", "s", 1, "", "", "") for k in range(10, 45))]


def joined(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars):
    return joined(*map(field, (doc_id, source, lang, n_chars, text)))


def levels_over(nodes):
    """All levels of a tree: pairs, a lone last node by itself."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([joined(*below[k:k + 2]) for k in range(0, len(below), 2)])
    return levels


def steps(levels, k):
    """(node, left sibling, right sibling) upwards, siblings empty where there are none."""
    found = []
    for level in levels[:-1]:
        pair = level[k & ~1:(k | 1) + 1]
        found.append(("", pair[1] if len(pair) > 1 else "") if k % 2 == 0 else (pair[0], ""))
        k //= 2
    return found


def plain(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf(*row[:5]), row))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    built = {n: levels_over([t[2] for t in sorted(trees[n], key=lambda t: t[:3])]) for n in names}
    over = levels_over([built[n][-1][0] for n in names])
    out = []
    for at, n in enumerate(names):
        for k, (_, _, digest, row) in enumerate(sorted(trees[n], key=lambda t: t[:3])):
            way = steps(built[n], k) + steps(over, at)
            folded = digest
            if row[0] is not None and crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None:
                folded = leaf(*row[:4], row[4] + 1)
            for left, right in way:
                folded = joined(left, folded, right)
            out.append((row[0], digest, built[n][-1][0], over[-1][0],
                        joined(*(a + b for a, b in way)), folded, folded == over[-1][0]))
    return Counter(out), built, over


def collected(df):
    return Counter(map(tuple, df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


def test_query_matches_plain_tree(spark):
    rows = [tuple(r) for r in read_documents(spark, SF).select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    got = collected(queries.QUERIES["op13_merkle_manifest"](spark, SF))
    assert got == plain(rows)[0]
    assert 0 < sum(not r[-1] for r in got) < len(rows) / 4


@pytest.mark.parametrize("run_levels", [1, 2, 10])
def test_awkward_tables(spark, run_levels):
    table = spark.createDataFrame(AWKWARD, SCHEMA).repartition(5)
    assert collected(manifest.verify(table, run_levels)) == plain(AWKWARD)[0]


def test_small_tables(spark):
    for rows in ([], AWKWARD[:1], AWKWARD[4:5], AWKWARD[:3], AWKWARD[3:6]):
        assert collected(manifest.verify(spark.createDataFrame(rows, SCHEMA), 1)) == (
            plain(rows)[0] if rows else Counter())


@pytest.mark.parametrize("run_levels", [1, 3])
def test_whole_log_is_in_postorder(spark, run_levels):
    _, built, over = plain(AWKWARD)
    got = manifest.postorder_log(spark.createDataFrame(AWKWARD, SCHEMA), run_levels).collect()
    trees = {"" if n is None else "=" + n: levels for n, levels in built.items()} | {"top": over}
    want = {(t, level, k, d) for t, levels in trees.items() for level, row in enumerate(levels)
            for k, d in enumerate(row)}
    assert {(r["tree"], r["level"], r["number"], r["digest"]) for r in got} == want
    assert len(got) == len(want)
    for tree, levels in trees.items():
        order = sorted((r["place"], r["level"], r["number"]) for r in got if r["tree"] == tree)
        assert [p for p, _, _ in order] == list(range(len(order)))
        assert [o[1:] for o in order] == postorder(levels, len(levels) - 1, 0)


def postorder(levels, level, number):
    below = [] if level == 0 else [
        n for k in range(2 * number, min(2 * number + 2, len(levels[level - 1])))
        for n in postorder(levels, level - 1, k)]
    return below + [(level, number)]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 200), st.integers(0, 3))
def test_log_places(leaves, more):
    """A builder's log holds each node at its place, in a tree or in a run that goes higher."""
    nodes = [sha256(str(k).encode()).hexdigest() for k in range(leaves)]
    levels = levels_over(nodes)
    for _ in range(more):
        levels.append([joined(levels[-1][0])])
    height = len(levels) - 1
    log = manifest.build_log([bytes.fromhex(n) for n in nodes], height)
    assert len(log) == 32 * manifest.log_size(leaves, height)
    for level, row in enumerate(levels):
        for k, digest in enumerate(row):
            at = 32 * manifest.place(level, k, leaves, height)
            assert log[at:at + 32].hex() == digest
    for k in range(leaves):
        path = manifest.path_in_log(log, k, leaves, height)
        assert manifest.fold(bytes.fromhex(nodes[k]), path) == log[-32:]
