"""Exact Jaccard join of shingle sets through group counts in an R-tree.

Shingles are hashed into groups. The counts per group are a point, and the overlap of two sets is
at most the sum of the smaller coordinate of their points, so an R-tree over the points, whose
nodes know the largest coordinates below them, skips whole branches that cannot reach the
overlap needed. A single tree would have to sit in one place; the same hashing also says which
sets must meet. Two linked sets of which the smaller has n shingles differ in at most
``D = n * (100 - p) / p`` of them; spread over more than D groups, they agree on all shingles of
some group. So sets are dealt out by (group, hash of the group's shingles), and only sets that
agree on a whole group share a bucket.

1. Equal sets become one class. Buckets with several classes are kept.
2. Every class is compared with the first one of its buckets, exactly, if their points let them
   be linked. Components follow.
3. In buckets that still hold several components, the R-tree finds the sets that may be linked
   with one of another component. Only their texts go to the bucket, which compares them exactly
   and gives out links that join two components there: at most as many as it has sets, however
   many pairs came near. Components of all links are the result.

No link is lost: a pair in a shared bucket is either in one component already or compared.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID
from tidemark.llm.components import components
from tidemark.llm.textbytes import LOWER, grouped, mix, running, span_hash, word_hashes, words
from tidemark.session import materialise, materialise_by

SHINGLE, PERCENT = 4, 85
#: The tree works on 2 ** 5 groups; what it leaves is bounded again on about n / 2 groups.
TREE_BITS, MOST_BITS = 5, 14
SEEDS = 8
#: Rows of a bucket that one R-tree holds; larger buckets are searched block by block.
BLOCK = 4096
#: Shingles of a bucket that are held at once; buckets with more are split likewise.
BLOCK_SHINGLES = 1 << 23


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for low, high, data, offsets in grouped(column):
        data = LOWER[data]
        found = words(data, offsets)
        counts = np.diff(found.first)
        per_row = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        begin = np.cumsum(per_row) - per_row
        starts = (np.arange(int(per_row.sum()), dtype=np.int64)
                  + np.repeat(found.first[:-1] - begin, per_row))
        ends = starts + np.repeat(np.minimum(counts, width), per_row)
        hashes = span_hash(running(word_hashes(data, found)), starts, ends)
        edges = np.r_[0, np.cumsum(per_row)]
        for k in range(high - low):
            yield np.unique(hashes[edges[k]:edges[k + 1]])


# ---------------------------------------------------------------------------------------------
# Which sets meet
# ---------------------------------------------------------------------------------------------
def most_differing(n: int, percent: int) -> int:
    """Shingles in which two linked sets can differ if the smaller has ``n``."""
    return n * (100 - percent) // percent


#: Bands double in two steps; in four for sets that may differ by much, to keep groups full.
_RATIO, _FINE_RATIO, _FINE_BELOW, LEAST_PERCENT = 2 ** 0.5, 2 ** 0.25, 75, 60


def _ratio(percent: int) -> float:
    return _RATIO if percent >= _FINE_BELOW else _FINE_RATIO


@cache
def empty_share(percent: int) -> float:
    """Empty groups to expect per shingle in which linked sets may differ.

    A band's groups are as many as its largest set needs, empty ones included; a set at its
    lower edge leaves ``exp(-n / groups)`` of them empty. The share solves that equation.
    """
    if not LEAST_PERCENT <= percent <= 99:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 99, not {percent}")
    share = 0.0
    for _ in range(200):
        load = percent / ((100 - percent) * _ratio(percent) * (1 + share))
        share = 1 / np.expm1(load)
    return share


def spare(differing, percent: int):
    """Empty groups a set may have and still be found by the others: what is to be expected and
    three standard deviations."""
    expected = empty_share(percent) * differing
    return 3 + np.ceil(expected + 3 * np.sqrt(expected)).astype(np.int64)


def groups_sent(n, percent: int):
    differing = most_differing(n, percent)
    return differing + 1 + spare(differing, percent)


@cache
def bands(percent: int) -> tuple[int, ...]:
    """First size of each band, each a fixed ratio above the one before."""
    first = next(n for n in range(1, 1000) if most_differing(n, percent) > 0)
    out = [first]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, ceil(out[-1] * _ratio(percent))))
    return tuple(out)


_STEP = np.uint64(0xD1342543DE82EF95)


def bucket_keys(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the buckets of one set; sets too small to differ have none.

    Two sets meet by the grouping of the smaller one's band, so a set goes by its own band and
    by those in which a smaller partner may be. Empty groups would be shared by everyone and
    are not sent. If either of two linked sets has no more of them than is spare among the
    groups that the smaller one sends, some group is left on which both agree. A set for which
    that does not hold, whatever its partner's size, goes by another seed as well.
    """
    n = len(shingles)
    edges = bands(percent)
    if n < edges[0]:
        return np.zeros(0, np.uint64)
    smallest = max(-(-n * percent // 100), edges[0])
    own = int(np.searchsorted(edges, n, side="right")) - 1
    low = int(np.searchsorted(edges, smallest, side="right")) - 1
    out = []
    for band in range(low, own + 1):
        top = edges[band + 1] - 1
        groups = int(groups_sent(top, percent))
        # Sizes that the smaller of the two may have here, what it sends, and what is spare.
        sizes = np.arange(max(smallest, edges[band]), min(n, top) + 1, dtype=np.int64)
        sent = groups_sent(sizes, percent)
        allowed = spare(most_differing(sizes, percent), percent)
        for seed in range(SEEDS + 1):
            if seed == SEEDS:
                raise RuntimeError(f"{SEEDS} groupings of {n} shingles left too many groups empty")
            name = mix(np.array([band * 64 + seed], np.uint64) * _STEP)[0]
            spun = mix(shingles + name)
            group = (spun >> np.uint64(20)) % np.uint64(groups)
            order = np.argsort(group, kind="stable")
            ordered = group[order]
            heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            sums = np.add.reduceat(mix(spun ^ _STEP)[order], heads)
            names = ordered[heads]
            used = names < sent[-1]
            out.append(mix(sums[used] + names[used] * _STEP + name))
            empty = sent - np.searchsorted(names.astype(np.int64), sent)
            if (empty <= allowed).all():
                break
    return np.concatenate(out)


def point_of(shingles: np.ndarray) -> np.ndarray:
    """Counts per group; about half as many groups as shingles, by the top bits of the hash."""
    bits = min(max(TREE_BITS, len(shingles).bit_length() - 1), MOST_BITS)
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The point over fewer groups: neighbours in the order of the hash are added up."""
    return point.reshape(groups, -1).sum(axis=1)


def packed(point: np.ndarray) -> bytes:
    """The counts' low bytes, then the high ones, which are mostly zero, deflated."""
    return zlib.compress(point.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def read_point(body: bytes) -> np.ndarray:
    low, high = np.frombuffer(zlib.decompress(body), np.uint8).astype(np.int64).reshape(2, -1)
    return low + (high << 8)


def sketches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """id, set size, two hashes of the set, and its point."""
    for batch in batches:
        size, one, two, points, coarse = [], [], [], [], []
        for shingles in shingle_sets(batch.column("text"), width):
            size.append(len(shingles))
            one.append(int(mix(shingles).sum(dtype=np.uint64).view(np.int64)))
            two.append(int(mix(shingles ^ _STEP).sum(dtype=np.uint64).view(np.int64)))
            point = point_of(shingles)
            points.append(packed(point))
            coarse.append(folded(point, 1 << TREE_BITS).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
             pa.array(two, pa.int64()), pa.array(coarse, pa.list_(pa.int32())),
             pa.array(points, pa.binary())],
            ["id", "n", "s1", "s2", "coarse", "point"])


def dealt(batches: Iterator[pa.RecordBatch], width: int, percent: int
          ) -> Iterator[pa.RecordBatch]:
    """Bucket keys of every text with the first hash of its set; equal sets of a batch once."""
    for batch in batches:
        seen, keys, sets = set(), [], []
        for shingles in shingle_sets(batch.column("text"), width):
            own = bucket_keys(shingles, percent)
            name = mix(shingles).sum(dtype=np.uint64).view(np.int64)
            if len(own) and name not in seen:
                seen.add(name)
                keys.append(own.view(np.int64))
                sets.append(np.full(len(own), name, np.int64))
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate(sets))], ["key", "s1"])


def bucket_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct sets of every bucket with at least two, with the bucket's first set.

    Rows come sorted by key and set and are read as a stream.
    """
    key = first = last = None
    shown = False                          # whether the first set of the run is out
    for batch in batches:
        keys, sets = batch.column("key").to_numpy(), batch.column("s1").to_numpy()
        if not len(keys):
            continue
        starts = np.r_[key is None or keys[0] != key, keys[1:] != keys[:-1]]
        fresh = starts | np.r_[last is None or sets[0] != last, sets[1:] != sets[:-1]]
        at = np.maximum.accumulate(np.where(starts, np.arange(len(keys)), -1))
        pivot = np.where(at < 0, first if first is not None else 0, sets[np.maximum(at, 0)])
        others = np.flatnonzero(fresh & ~starts)
        run = np.cumsum(starts)                        # 0: the run of the batch before
        runs, at_first = np.unique(run[others], return_index=True)
        leads = others[at_first]                       # with each, the bucket's first set goes out
        if shown:
            leads = leads[run[leads] > 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[keys[others], keys[leads]]),
             pa.array(np.r_[pivot[others], pivot[leads]]),
             pa.array(np.r_[sets[others], pivot[leads]])], ["key", "pivot", "s1"])
        shown = bool(np.isin(run[-1], runs)) or (run[-1] == 0 and shown)
        key, first, last = keys[-1], pivot[-1], sets[-1]


# ---------------------------------------------------------------------------------------------
# R-tree over group counts
# ---------------------------------------------------------------------------------------------
class CountTree:
    """Packed R-tree: points sorted by size and coordinates, sixty-four to a node, level by level."""

    FANOUT = 64

    def __init__(self, points: np.ndarray, sizes: np.ndarray) -> None:
        spread_most = np.argsort(-points.var(axis=0))[:2] if len(points) else [0, 1]
        tile = np.argsort(sizes, kind="stable").argsort() // (8 * self.FANOUT)
        self.order = np.lexsort((points[:, spread_most[1]], points[:, spread_most[0]], tile))
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > self.FANOUT:
            high, least, most = self.levels[-1]
            at = np.arange(0, len(high), self.FANOUT)
            self.levels.append((np.maximum.reduceat(high, at, axis=0),
                                np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)))

    def search(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Indices of the points whose set may be linked with the given one."""
        here = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least, most = (a[here] for a in self.levels[depth])
            overlap = np.minimum(np.minimum(high, point).sum(axis=1), np.minimum(most, size))
            # overlap >= p / (100 + p) * (size + other size), with the smallest size below
            here = here[(100 + percent) * overlap >= percent * (size + least)]
            if depth and len(here):
                below = len(self.levels[depth - 1][0])
                here = (here[:, None] * self.FANOUT + np.arange(self.FANOUT)).ravel()
                here = here[here < below]
        return self.order[here]


def contested(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows that the points let be linked with one of another component in (key, block).

    Rows come sorted by key, block and role. Roles: 0 member only, 1 member and query, 2 query
    only; members fill the tree before the queries that are not members arrive.
    """
    where, rows, held = None, [], 0

    def close() -> Iterator[pa.RecordBatch]:
        """The rows of the (key, block) that have a partner among those that are in."""
        size = sum(r[4] < 2 for r in rows)             # members come first
        asking = [k for k, r in enumerate(rows) if r[4] > 0]
        if not size or not asking:
            return
        sizes, comps = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
        coarse = np.array([folded(r[3], 1 << TREE_BITS) for r in rows])
        if len(rows) <= CountTree.FANOUT:              # one leaf: all at once
            overlap = np.minimum(coarse[:, None], coarse[None]).sum(axis=2)
            near = (100 + percent) * overlap >= percent * (sizes[:, None] + sizes[None])
            near &= comps[:, None] != comps[None]
            near = np.triu(near)
            found = {k: np.flatnonzero(near[k]) for k in np.flatnonzero(near.any(axis=1))}
        else:
            tree = CountTree(coarse[:size], sizes[:size])
            found = {k: tree.search(coarse[k], sizes[k], percent) for k in asking}
            found = {k: near[comps[near] != comps[k]] for k, near in found.items()}
        found = {k: near for k, near in found.items() if len(near)}
        if not found:
            return
        groups = min(len(r[3]) for r in rows)          # of one band, so alike for all
        fine = np.array([folded(r[3], groups) for r in rows])
        involved = np.zeros(len(rows), bool)
        for k, near in found.items():
            overlap = np.minimum(fine[near], fine[k]).sum(axis=1)
            near = near[(100 + percent) * overlap >= percent * (sizes[k] + sizes[near])]
            involved[near] = True
            involved[k] |= len(near) > 0
        out = [rows[k] for k in np.flatnonzero(involved)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([where[0]] * len(out), pa.int64()), pa.array([where[1]] * len(out), pa.int32()),
             pa.array([r[4] for r in out], pa.int32()), pa.array([r[0] for r in out], pa.int64()),
             pa.array([r[1] for r in out], pa.int64())], ["key", "block", "role", "id", "component"])

    for batch in batches:
        table = [batch.column(k).to_pylist()
                 for k in ("key", "block", "id", "component", "n", "point", "role")]
        for key, block, row_id, component, n, point, role in zip(*table):
            if (key, block) != where:
                yield from close()
                where, rows, held = (key, block), [], 0
            elif role == 2 and (len(rows) >= 2 * BLOCK or held >= 2 * BLOCK_SHINGLES):
                yield from close()                     # queries in portions
                rows = [r for r in rows if r[4] < 2]
                held = sum(r[2] for r in rows)
            rows.append((row_id, component, n, read_point(point), role))
            held += n
    yield from close()


# ---------------------------------------------------------------------------------------------
# Exact comparison
# ---------------------------------------------------------------------------------------------
def possible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs that their points, over the groups of the smaller one, let be linked."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        table = [batch.column(k).to_pylist() for k in ("n_a", "n_b", "point_a", "point_b")]
        for k, (n_a, n_b, *bodies) in enumerate(zip(*table)):
            points = [read_point(body) for body in bodies]
            groups = min(map(len, points))
            overlap = np.minimum(*(folded(point, groups) for point in points)).sum()
            keep[k] = (100 + percent) * overlap >= percent * (n_a + n_b)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def let_by_points(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs of ids of which some texts may be linked; a point is a tenth of its text."""
    def named(side: str) -> DataFrame:
        return nodes.where("n > 0").select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"),
                                           F.col("point").alias(f"point_{side}"))

    return (pairs.join(named("a"), "a").join(named("b"), "b")
            .select("a", "b", "n_a", "n_b", "point_a", "point_b")
            .mapInArrow(lambda it: possible(it, percent), "a bigint, b bigint").distinct())


def linked(batches: Iterator[pa.RecordBatch], width: int, percent: int
           ) -> Iterator[pa.RecordBatch]:
    """The pairs whose texts are linked."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        pairs = zip(shingle_sets(batch.column("text_a"), width),
                    shingle_sets(batch.column("text_b"), width))
        for k, (one, two) in enumerate(pairs):
            shared = len(np.intersect1d(one, two, assume_unique=True))
            keep[k] = shared > 0 and 100 * shared >= percent * (len(one) + len(two) - shared)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
            .mapInArrow(lambda it: linked(it, width, percent), "a bigint, b bigint").distinct())


def joining_links(batches: Iterator[pa.RecordBatch], width: int, percent: int
                  ) -> Iterator[pa.RecordBatch]:
    """Links that join two components within a (key, block); rows come as for ``contested``.

    Every query is compared with all members of other components, by counting how many of its
    shingles each of them holds. Queries that are not members are compared one by one and not
    kept.
    """
    where, sets, ids, names = None, [], [], []
    joined: dict[int, int] = {}                        # component to the one it has gone into

    def root(name: int) -> int:
        while joined.get(name, name) != name:
            name = joined[name]
        return name

    for batch in batches:
        links = []
        table = [batch.column(k).to_pylist() for k in ("key", "block", "role", "id", "component")]
        for key, block, role, row_id, name, own in zip(*table, shingle_sets(batch.column("text"),
                                                                            width)):
            if (key, block) != where:
                where, sets, ids, names, joined = (key, block), [], [], [], {}
            if not len(own):                           # another text of the same id
                continue
            mine = root(name)
            roots = [root(other) for other in names] if role else []
            apart = [k for k, other in enumerate(roots) if other != mine
                     and 100 * min(len(sets[k]), len(own)) >= percent * max(len(sets[k]), len(own))]
            if apart:
                sizes = np.array([len(sets[k]) for k in apart])
                shingles = np.concatenate([sets[k] for k in apart])
                at = np.minimum(np.searchsorted(own, shingles), len(own) - 1)
                shared = np.add.reduceat((own[at] == shingles).astype(np.int64),
                                         np.cumsum(sizes) - sizes)
                near = 100 * shared >= percent * (sizes + len(own) - shared)
                for k in np.flatnonzero(near):
                    other = root(names[apart[k]])
                    if other != root(name):
                        joined[other] = root(name)
                        links.append((row_id, ids[apart[k]]))
            if role < 2:
                sets.append(own)
                ids.append(row_id)
                names.append(name)
        yield pa.RecordBatch.from_arrays(
            [pa.array([min(x) for x in links], pa.int64()),
             pa.array([max(x) for x in links], pa.int64())], ["a", "b"])


def pair_of(a: str, b: str) -> tuple:
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def bound_holds(percent: int) -> Column:
    """Whether sizes and coarse points let two sets be linked."""
    overlap = F.aggregate(F.zip_with("coarse_a", "coarse_b", lambda x, y: F.least(x, y)),
                          F.lit(0).cast("bigint"), lambda total, x: total + x)
    return (100 + percent) * overlap >= percent * (F.col("n_a") + F.col("n_b"))


def _once(near: DataFrame) -> DataFrame:
    """Of blocks with the same rows one: sets that are alike share many buckets."""
    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), "role", "id").cast("decimal(38,0)"))

    block = F.struct("key", "block")
    kept = (near.groupBy("key", "block").agg(F.count("*").alias("n"), total(1).alias("one"),
                                             total(2).alias("two"))
            .groupBy("n", "one", "two").agg(F.min(block).alias("kept")).select("kept.*"))
    return near.join(kept, ["key", "block"], "left_semi")


def similarity_components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT
                          ) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Words are lower-cased in A-Z only. A text of fewer words than a shingle has its whole
    sequence as the one shingle; null texts and texts without words have none and are linked
    with nothing. Documents are linked when ``100 * |A and B| >= percent * |A or B|``;
    component_id is the smallest id reachable by links. Rows with the same id count as one
    document with several texts, rows without an id as one document without an id, which comes
    before all others. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    nodes = materialise(rows.mapInArrow(
        lambda it: sketches(it, width),
        "id bigint, n bigint, s1 bigint, s2 bigint, coarse array<int>, point binary"))
    classes = materialise(nodes.where("n > 0").groupBy("s1", "s2").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("coarse").alias("coarse"),
        F.first("point").alias("point")))
    members = materialise(
        rows.select("text").mapInArrow(lambda it: dealt(it, width, percent),
                                       "key bigint, s1 bigint")
        .repartition("key").sortWithinPartitions("key", "s1")
        .mapInArrow(bucket_members, "key bigint, pivot bigint, s1 bigint"))
    short = classes.select("s1", F.col("rep").alias("id"), "n", "coarse")

    # Classes in shared buckets, and the texts that comparisons need.
    met = members.select("s1").distinct()
    texts = materialise_by(rows.join(short.join(met, "s1").select("id").distinct(), "id"), "id")

    def named(side: str, key: str) -> DataFrame:
        return short.select(F.col("s1").alias(key), F.col("id").alias(side),
                            F.col("n").alias(f"n_{side}"), F.col("coarse").alias(f"coarse_{side}"))

    tried = materialise(
        members.where("s1 <> pivot").select("pivot", "s1").distinct()
        .join(named("a", "pivot"), "pivot").join(named("b", "s1"), "s1")
        .where("a <> b").where(bound_holds(percent)).select(*pair_of("a", "b")).distinct())
    tried = materialise(let_by_points(tried, nodes, percent))
    links = materialise(verified(tried, texts, width, percent))
    comps = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    # Buckets with several components; their first sets have met all others already.
    placed = (members.where("s1 <> pivot").join(short, "s1")
              .join(comps.withColumnRenamed("node", "id"), "id", "left")
              .select("key", "id", "n", F.coalesce("component", "id").alias("component")))
    pieces = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    open_keys = (placed.groupBy("key").agg(F.min("component").alias("x"),
                                           F.max("component").alias("y"),
                                           pieces.cast("int").alias("blocks")).where("x <> y"))
    placed = materialise(placed.join(open_keys.select("key", "blocks"), "key"))
    big = placed.where("blocks > 1")
    main = (big.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key")
            .agg(F.max_by("component", "c").alias("main")))
    dealt_blocks = F.pmod(F.xxhash64("id"), F.col("blocks").cast("bigint")).cast("int")
    columns = ("key", "block", "role", "id", "component")
    points = classes.select(F.col("rep").alias("id"), "n", "point")
    small_rows = (placed.where("blocks = 1").withColumn("block", F.lit(0))
                  .withColumn("role", F.lit(1)).select(*columns))
    big_members = big.withColumn("block", dealt_blocks).withColumn("role", F.lit(0)).select(*columns)
    big_queries = (big.join(main, "key").where("component <> main")
                   .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                   .withColumn("role", F.lit(2)).select(*columns))
    near = (small_rows.unionByName(big_members).unionByName(big_queries).join(points, "id")
            .repartition("key", "block").sortWithinPartitions("key", "block", "role")
            .mapInArrow(lambda it: contested(it, percent),
                        "key bigint, block int, role int, id bigint, component bigint")
            .distinct())
    more = (_once(materialise(near)).join(texts, "id").repartition("key", "block")
            .sortWithinPartitions("key", "block", "role")
            .mapInArrow(lambda it: joining_links(it, width, percent), "a bigint, b bigint")
            .distinct())

    final = components(links.unionByName(more).select(F.col("a").alias("u"),
                                                      F.col("b").alias("v")))
    out = (nodes.join(classes.select("s1", "s2", "rep"), ["s1", "s2"], "left")
           .withColumn("node", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("id")))
           .join(final, "node", "left"))
    return out.select(
        F.nullif(F.col("id"), F.lit(NULL_ID)).alias("doc_id"), F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component", "node"), F.lit(NULL_ID)).alias("component_id"))


def _named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows, each as ``row`` with a ``node``, and the nodes: node, id, text hash, copies.

    A node stands for an id with one text. It is the id itself where that has no other text
    and no copies; the other rows are told apart by a hash of id and text, under a seed for which
    no two nodes meet.
    """
    key = F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NULL_ID))
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key.alias("id"),
                       text.alias("text"))
    texts = materialise(rows.groupBy("id", F.md5("text").alias("hash"))
                        .agg(F.count("*").alias("copies")))
    crowded = materialise(texts.groupBy("id").agg(F.sum("copies").alias("rows"))
                          .where((F.col("rows") > 1) | (F.col("id") == NULL_ID)).select("id"))
    crowded = crowded.withColumn("crowded", F.lit(True))
    for seed in range(SEEDS):
        def node(hashed: Column, seed: int = seed) -> Column:
            return F.when(F.col("crowded"), F.xxhash64(F.lit(seed), "id", hashed)) \
                .otherwise(F.col("id"))

        nodes = texts.join(crowded, "id", "left").withColumn("node", node(F.col("hash")))
        counts = nodes.agg(F.count("*").alias("n"), F.countDistinct("node").alias("d")).first()
        if counts["n"] == counts["d"]:
            return (rows.join(crowded, "id", "left").select(
                "row", "text", node(F.md5("text")).alias("node")),
                nodes.select("node", "id", "hash", "copies"))
    raise RuntimeError(f"{SEEDS} seeds gave equal names to different rows")


def one_of_each(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, without those for which another of their group stays.

    Of rows with linked texts that with the smallest id stays, a missing id before all others;
    of an id's texts the one with the smallest hash, and of equal rows one. An id with several
    texts is a document for each: one that is linked with nothing stays, whatever becomes of
    the others. Texts without words are linked with nothing and stay, however often they are there.
    Columns may have any names; an empty table gives no rows.
    """
    rows, nodes = _named(docs)
    found = similarity_components(rows.select(F.col("node").alias("doc_id"), "text"),
                                  width, percent).where("n_shingles > 0")
    members = materialise(found.select(F.col("doc_id").alias("node"), "component_id").distinct()
                          .join(nodes, "node"))
    place = F.struct("id", "hash")
    first = members.groupBy("component_id").agg(F.min(place).alias("first"))
    # Written first: where they are small, their known size spares the documents a shuffle.
    gone = materialise(members.join(first, "component_id").where(place != F.col("first"))
                       .select("node"))
    copied = materialise(members.where("copies > 1").select("node"))
    kept = rows.drop("text").join(gone, "node", "left_anti")
    single = kept.join(copied, "node", "left_anti")
    several = kept.join(copied, "node", "left_semi").dropDuplicates(["node"])
    return single.unionByName(several).select("row.*")


#: Every pair of documents that share a shingle, counted, and what links reach.
ORACLE_SQL = f"""
with recursive w as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (
    select doc_id, case when len(ws) = 0 then [] when len(ws) < {SHINGLE} then
        [array_to_string(ws, ' ')] else list_distinct(list_transform(
            range(1, len(ws) - {SHINGLE} + 2),
            lambda i: array_to_string(ws[i:i + {SHINGLE} - 1], ' '))) end as own from w),
e as (select doc_id, unnest(own) as shingle from s),
pairs as (
    select a.doc_id as u, b.doc_id as v, count(*) as shared
    from e a join e b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (
    select u, v from pairs join s a on a.doc_id = u join s b on b.doc_id = v
    where 100 * shared >= {PERCENT} * (len(a.own) + len(b.own) - shared)),
ways as (select u, v from links union select v, u from links),
reach(doc_id, other) as (
    select doc_id, doc_id from s
    union
    select r.doc_id, ways.v from reach r join ways on ways.u = r.other)
select doc_id, any_value(len(own))::bigint as n_shingles, min(other) as component_id
from reach join s using (doc_id) group by doc_id
"""
