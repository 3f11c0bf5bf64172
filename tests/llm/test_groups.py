"""Which sets meet, one document of each group, and the mix, row by row."""

import random
from collections import Counter

import numpy as np
import plain_text as brute
import pyarrow as pa
import pytest

from tidemark.llm import mixing, similarity_join

ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def pairs_at(percent, size, rng):
    """A set and one that is just linked with it, by dropping, adding and swapping shingles."""
    base = np.unique(rng.integers(0, 1 << 63, size + 40).astype(np.uint64))[:size]
    most = similarity_join.most_differing(size, percent)
    extra = np.unique(rng.integers(1 << 62, 1 << 63, most + 1).astype(np.uint64))
    yield base, base[: -(-size * percent // 100)]
    swapped = 0
    while 100 * (size - swapped - 1) >= percent * (size + swapped + 1):
        swapped += 1
    yield base, np.union1d(base[swapped:], extra[:swapped])
    yield base, np.union1d(base, extra[:size * (100 - percent) // percent])


@pytest.mark.parametrize("percent", [60, 70, 80, 85, 90])
def test_linked_sets_share_a_bucket(percent):
    rng = np.random.default_rng(percent)
    for size in (7, 12, 25, 60, 113, 240, 600, 800, 1500):
        for _ in range(6):
            for a, b in pairs_at(percent, size, rng):
                both = len(np.intersect1d(a, b))
                assert 100 * both >= percent * (len(a) + len(b) - both)
                if len(a) == len(b) == both:
                    continue
                keys = [set(similarity_join.bucket_keys(np.sort(s), percent)) for s in (a, b)]
                assert keys[0] & keys[1], (percent, size, len(a), len(b))


@pytest.mark.parametrize("percent", [70, 80, 85, 90])
def test_keys_per_set_are_bounded(percent):
    """About the groups of one or two bands, and none that very many sets share."""
    rng = np.random.default_rng(1)
    shared = Counter()
    for size in (60, 200, 600, 800, 5000):
        counts = []
        for _ in range(12):
            keys = similarity_join.bucket_keys(
                np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64)), percent)
            counts.append(len(keys))
            shared.update(set(keys.tolist()))
        assert np.mean(counts) <= 3 * int(similarity_join.groups_sent(size, percent))
    assert max(shared.values()) == 1
    with pytest.raises(ValueError, match="percent"):
        similarity_join.bucket_keys(np.arange(50, dtype=np.uint64), 50)


def let(pairs, percent):
    """Whether the points let each pair of sets be linked."""
    sides = [[np.unique(pair[k]) for pair in pairs] for k in (0, 1)]
    batch = pa.RecordBatch.from_pydict(
        {"a": list(range(len(pairs))), "b": list(range(len(pairs)))}
        | {f"n_{k}": [len(s) for s in side] for k, side in zip("ab", sides)}
        | {f"point_{k}": [similarity_join.packed(similarity_join.point_of(s)) for s in side]
           for k, side in zip("ab", sides)})
    kept = {k for out in similarity_join.possible([batch], percent)
            for k in out.column("a").to_pylist()}
    return [k in kept for k in range(len(pairs))]


@pytest.mark.parametrize("percent", [60, 80, 85, 90])
def test_points_keep_linked_pairs_and_drop_far_ones(percent):
    rng = np.random.default_rng(percent)
    linked = [pair for size in (7, 25, 113, 600, 1500) for pair in pairs_at(percent, size, rng)]
    assert all(let(linked, percent))
    assert all(let([pair[::-1] for pair in linked], percent))
    far = [rng.integers(0, 1 << 63, (2, 2000)).astype(np.uint64) * np.uint64(2) for _ in range(5)]
    assert not any(let(far, percent))


def test_packed_points_are_small_and_exact():
    rng = np.random.default_rng(3)
    point = similarity_join.point_of(rng.integers(0, 1 << 63, 600).astype(np.uint64) * np.uint64(2))
    assert len(similarity_join.packed(point)) <= len(point)
    for counts in (point, np.array([0, 1, 255, 256, 65535, 300, 7, 0])):
        assert similarity_join.read_point(similarity_join.packed(counts)).tolist() == counts.tolist()


def test_comparisons_leave_texts_where_they_lie(spark, monkeypatch):
    seen, verified = [], similarity_join.verified

    def watched(pairs, texts, *rest):
        joined = pairs.hint("merge").join(texts.withColumnRenamed("id", "a"), "a")
        seen.append(joined._jdf.queryExecution().executedPlan().toString())
        return verified(pairs, texts, *rest)

    monkeypatch.setattr(similarity_join, "verified", watched)
    similarity_join.similarity_components(spark.createDataFrame(group_rows(), "doc_id bigint, text string"))
    assert len(seen) == 1 and seen[0].count("Exchange hashpartitioning(a#") == 1   # of the pairs
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def words(*parts):
    return " ".join(f"{name}{k}" for name, count in parts for k in range(count))


def group_rows():
    """Groups that are linked in chains, rows without id, ids with several texts, equal rows."""
    base = words(("w", 60))
    rows = [(1, base), (0, base), (1, words(("other", 40))),       # one id, two texts
            (5, words(("five", 30))), (5, words(("five", 30))),    # equal rows
            (None, words(("none", 30))), (None, words(("none", 30))),
            (None, words(("lonely", 20))), (12, words(("lonely", 20))),
            (7, ""), (7, ""), (8, None), (None, ""), (9, "two words")]
    shuffled = random.Random(4)
    for group in range(12):
        text = [f"g{group}x{k}" for k in range(80)]
        for copy in range(4):
            rows.append((100 + shuffled.randrange(400), " ".join(text)))
            text[shuffled.randrange(80)] = f"g{group}c{copy}"
    return rows


def plain_groups(rows, width, percent):
    """The rows that stay: of every group the smallest (id, text), equal rows once."""
    import hashlib
    distinct = sorted({(i is not None, i or 0, hashlib.md5((t or "").encode()).hexdigest(), t or "")
                       for i, t in rows})
    parts = [brute.shingles(d[3], width) for d in distinct]
    root = list(range(len(distinct)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(distinct)):
        for b in range(a):
            both = len(parts[a] & parts[b])
            if both and 100 * both >= percent * len(parts[a] | parts[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    stay = {distinct[k][1:2] + distinct[k][3:] + (distinct[k][0],)
            for k in range(len(distinct)) if find(k) == k}
    out = Counter()
    for i, t in rows:
        key = (i or 0, t or "", i is not None)
        if key in stay:
            out[i, t] = out[i, t] + 1 if not brute.shingles(t or "", width) else 1
    return out


@pytest.mark.parametrize("width, percent", [(5, 80), (4, 85)])
def test_one_of_each_per_row(spark, width, percent):
    rows = group_rows()
    table = spark.createDataFrame([(*r, "en", "s", k, "x", "y") for k, r in enumerate(rows)],
                                  ROWS + ", node string, row string").repartition(4)
    kept = similarity_join.one_of_each(table, width, percent)
    assert kept.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == plain_groups(rows, width, percent)
    assert similarity_join.one_of_each(table.limit(0)).collect() == []


def test_mixed_documents_keep_their_columns(spark):
    settings = mixing.MixSettings(budget_percent=150)
    rows = [(k % 20 if k % 9 else None, words(("w", 3 + k % 5)), [None, "en", "none"][k % 3],
             [None, "src1", "src2"][k % 3], k, f"e{k}", f"f{k}", f"c{k}", f"d{k}")
            for k in range(60)] + [(99, "", "en", "src1", 0, "", "", "", ""),
                                   (98, None, None, None, 0, "", "", "", "")]
    table = spark.createDataFrame(
        rows, ROWS + ", epoch string, full string, cut string, domain string")
    mixed = mixing.mixed_documents(table, settings)
    assert mixed.columns == [*table.columns, "mix_domain", "mix_epoch"]
    got = mixed.collect()
    assert {tuple(r)[:9] for r in got} <= set(rows) and None in {r.lang for r in got}
    plain = Counter((r.doc_id, r.domain, r.epoch) for r in mixing.mix(table, settings).collect())
    assert Counter((r.doc_id, r.mix_domain, r.mix_epoch) for r in got) == plain
    bare = table.select("doc_id", "text", "lang", "source", "n_chars")
    assert mixing.mixed_documents(bare, settings).columns == [*bare.columns, "domain", "epoch"]
    assert mixing.mixed_documents(bare.limit(0), settings).count() == 0
