"""A Merkle manifest of a table, kept as a log of nodes in postorder.

Leaves are ordered within their language and cut into aligned runs of equal length. A builder
takes one run and writes the nodes of its subtree in the order they are completed: children
before their parent. Runs being aligned, such a log is a contiguous piece of the postorder of the
whole tree, and the place of any node follows from its level and number alone. Proofs are read
out of the logs by those places. Roots of runs are the leaves of the next round of builders, until
one root per language is left; the roots of the languages then form one more tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.session import materialise

#: A builder takes 2^RUN_LEVELS leaves: a log of 2,047 nodes.
RUN_LEVELS = 10
DIGEST = 32
#: The tree over all languages; those of languages are named "=" and the language, or "" for null.
TOP = "top"
# How a node meets its sibling on the way up: first byte of a step of a path.
_ALONE, _SIBLING_LEFT, _SIBLING_RIGHT = 0, 1, 2
_STEP = 1 + DIGEST

_LOG = ("tree string, full bigint, level int, run bigint, leaves bigint, total bigint, "
        "log binary, root binary, ids array<bigint>, tampered array<binary>")
_PATHS = "tree string, number bigint, path binary, subroot binary, root binary"
SCHEMA = ("doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def height_of(leaves: int) -> int:
    """Levels above the leaves of a tree of so many leaves."""
    return max(leaves - 1, 0).bit_length()


def log_size(leaves: int, height: int) -> int:
    """Nodes on levels 0 to ``height`` over so many leaves."""
    return sum(-(-leaves >> level) for level in range(height + 1))


def place(level: int, number: int, leaves: int, height: int) -> int:
    """Place in postorder of a node, given by its level and its number on that level.

    Before it come all nodes that end at an earlier leaf, and those below it that end at the
    same one. A node ends at its last leaf, and the last nodes of all levels end at the same.
    """
    end = min((number + 1) << level, leaves)
    below = sum(-(-end >> k) for k in range(level + 1))
    return below + sum((end - 1) >> k for k in range(level + 1, height + 1)) - 1


def build_log(leaves: list[bytes], height: int) -> bytes:
    """Digests of all nodes over these leaves up to ``height``, as they are completed."""
    log, open_nodes = [], []          # the nodes still without parent, by level

    def complete(digest: bytes, level: int) -> None:
        while True:
            log.append(digest)
            if level == height:
                return
            if len(open_nodes) <= level:
                open_nodes.append(None)
            if open_nodes[level] is None:
                open_nodes[level] = digest
                return
            pair = open_nodes[level].hex() + digest.hex()
            open_nodes[level] = None
            digest, level = sha256(pair.encode()).digest(), level + 1

    for leaf in leaves:
        complete(leaf, 0)
    # What is left open lies on the right edge: it gets a parent of its own, lowest level first.
    for level in range(height):
        if level < len(open_nodes) and open_nodes[level] is not None:
            alone, open_nodes[level] = open_nodes[level], None
            complete(sha256(alone.hex().encode()).digest(), level + 1)
    return b"".join(log)


def path_in_log(log: bytes, number: int, leaves: int, height: int) -> bytes:
    """The way up from a leaf to the log's root: per level a byte for the kind of step and the
    sibling's digest, read at its place in the log."""
    steps = []
    for level in range(height):
        node = number >> level
        other = node ^ 1
        if other << level >= leaves:
            steps.append(bytes(_STEP))
        else:
            at = place(level, other, leaves, height) * DIGEST
            kind = _SIBLING_LEFT if other < node else _SIBLING_RIGHT
            steps.append(bytes([kind]) + log[at:at + DIGEST])
    return b"".join(steps)


def proof_of(path: bytes) -> str:
    """The siblings of a path, hashed in the order of the way up."""
    return sha256("".join(path[at + 1:at + _STEP].hex() for at in range(0, len(path), _STEP)
                          if path[at] != _ALONE).encode()).hexdigest()


def fold(digest: bytes, path: bytes) -> bytes:
    """What a digest becomes along a path."""
    for at in range(0, len(path), _STEP):
        kind, own = path[at], digest.hex()
        other = path[at + 1:at + _STEP].hex()
        joined = own if kind == _ALONE else other + own if kind == _SIBLING_LEFT else own + other
        digest = sha256(joined.encode()).digest()
    return digest


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(n_chars: Column) -> Column:
    return F.unhex(F.sha2(F.concat(
        _field(F.col("doc_id")), _field(F.col("source")), _field(F.col("lang")),
        _field(n_chars), _field(F.col("text"))), 256))


def leaves_of(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, and the leaf as it would be after tampering (null where there is none).

    Tampering adds 1 to n_chars where 7 divides the crc32 of the id as text.
    """
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, _leaf(more))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       _leaf(F.col("n_chars")).alias("leaf"), tampered.alias("tampered"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``number``, a row's place in its tree by ``order``, and ``total``, the tree's rows.

    Sorted ranges number their own rows; small offsets per range and tree do the rest. The
    ranges are written before they are counted, so that no later run of a task can move a row.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, following = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            numbers = []
            for tree in batch.column("tree").to_pylist():
                if tree != current:
                    current, following = tree, 0
                numbers.append(following)
                following += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(numbers), pa.int64()),
                 pa.array(numbers, pa.int64())],
                [*batch.schema.names, "part", "seq"])

    schema = StructType([*rows.schema.fields, StructField("part", LongType()),
                         StructField("seq", LongType())])
    ranges = materialise(rows.repartitionByRange("tree", *order)
                         .sortWithinPartitions("tree", *order).mapInArrow(count, schema))
    # One row per range and tree that meet: at most ranges plus trees.
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.groupBy("tree", "part").agg(F.count("*").alias("rows"))
               .select("tree", "part",
                       F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
                       F.sum("rows").over(whole).alias("total")))
    return ranges.join(offsets, ["tree", "part"]).select(
        *rows.columns, (F.col("offset") + F.col("seq")).alias("number"), "total")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one tree and run at a time; they come sorted and are at most a run's length."""
    waiting: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = list(zip(batch.column("tree").to_pylist(), batch.column("run").to_pylist()))
        start = 0
        for k in range(len(keys)):
            if keys[k] != key:
                if k > start:
                    waiting.append(batch.slice(start, k - start))
                if waiting:
                    yield pa.Table.from_batches(waiting)
                waiting, start, key = [], k, keys[k]
        if len(keys) > start:
            waiting.append(batch.slice(start))
    if waiting:
        yield pa.Table.from_batches(waiting)


def _levels_here(total: int, run_levels: int) -> int:
    """Levels that a round adds to a tree of ``total`` nodes: up to its root, if that is near."""
    return min(run_levels, height_of(total))


def _build(nodes: DataFrame, level: int, run_levels: int) -> DataFrame:
    """One row per run of ``nodes``: its log, its root, and what its leaves carry, in order.

    ``level`` is the level that these nodes have in their whole tree.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            total = rows.column("total")[0].as_py()
            log = build_log(rows.column("leaf").to_pylist(), _levels_here(total, run_levels))
            first = rows.slice(0, 1).combine_chunks()
            count = rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(first.column(c).chunk(0) for c in ("tree", "full")),
                 pa.array([level], pa.int32()), first.column("run").chunk(0),
                 pa.array([count]), pa.array([total]),
                 pa.array([log], pa.binary()), pa.array([log[-DIGEST:]], pa.binary()),
                 pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([rows.column("tampered").to_pylist()], pa.list_(pa.binary()))],
                ["tree", "full", "level", "run", "leaves", "total", "log", "root", "ids",
                 "tampered"])

    runs = (nodes.withColumn("run", F.shiftright("number", run_levels))
            .repartition("tree", "run").sortWithinPartitions("tree", "run", "number"))
    return materialise(runs.mapInArrow(build, _LOG))


def build_logs(nodes: DataFrame, run_levels: int = RUN_LEVELS) -> list[DataFrame]:
    """The logs of all rounds, lowest first; the last one has a single run per tree.

    ``nodes`` has tree, doc_id, leaf, tampered, number and total.
    """
    nodes = nodes.withColumn("full", F.col("total"))
    largest = nodes.agg(F.max("total")).first()[0] or 0
    rounds: list[DataFrame] = []
    while True:
        rounds.append(_build(nodes, run_levels * len(rounds), run_levels))
        if largest <= 1 << run_levels:
            return rounds
        largest = -(-largest >> run_levels)
        fewer = F.shiftright(F.col("total") + ((1 << run_levels) - 1), run_levels)
        nodes = rounds[-1].select(
            "tree", "full", F.col("root").alias("leaf"), F.col("run").alias("number"),
            fewer.alias("total"), F.lit(None).cast("bigint").alias("doc_id"),
            F.lit(None).cast("binary").alias("tampered"))


def _paths(logs: DataFrame, above: DataFrame, run_levels: int) -> DataFrame:
    """The way up to the very root for every leaf of a round, given that of the runs' roots."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                height, leaves = _levels_here(row["total"], run_levels), row["leaves"]
                first = row["run"] << run_levels
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * leaves, pa.string()),
                     pa.array(range(first, first + leaves), pa.int64()),
                     pa.array([path_in_log(row["log"], k, leaves, height) + row["path"]
                               for k in range(leaves)], pa.binary()),
                     pa.array([row["subroot"]] * leaves, pa.binary()),
                     pa.array([row["root"]] * leaves, pa.binary())],
                    ["tree", "number", "path", "subroot", "root"])

    return _with_way_up(logs, above).mapInArrow(extract, _PATHS)


def _with_way_up(logs: DataFrame, above: DataFrame) -> DataFrame:
    return (logs.drop("root").withColumnRenamed("run", "number").join(above, ["tree", "number"])
            .withColumnRenamed("number", "run"))


def _ways_down(rounds: list[DataFrame], above: DataFrame, run_levels: int) -> DataFrame:
    """``above`` for the runs of the lowest round, from that of the trees' roots."""
    for logs in rounds[:0:-1]:
        above = _paths(logs, above, run_levels)
    return above


def _manifest(docs: DataFrame, run_levels: int) -> tuple[list[DataFrame], list[DataFrame],
                                                          DataFrame]:
    """Logs of the languages' trees, logs of the tree over them, and the names of its leaves."""
    leaves = numbered(materialise(leaves_of(docs)), ["doc_id", "leaf"])
    trees = build_logs(leaves, run_levels)
    names = trees[-1].select(
        F.lit(TOP).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("leaf"),
        F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("binary").alias("tampered"))
    # Names are bytes and start alike, so they sort as the languages do, null first.
    names = numbered(names, ["name"])
    return trees, build_logs(names.drop("name"), run_levels), names


def verify(docs: DataFrame, run_levels: int = RUN_LEVELS) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Digests are lowercase hex. ``folded_root`` follows the proof from the tampered leaf, where
    there is one; tampering adds 1 to n_chars of documents whose crc32 of the id 7 divides.

    Nulls count as ``-`` in leaves. Documents without language form the first tree; without id
    they come first in theirs. Repeated rows are leaves each; rows with one id are ordered by their
    leaf. A single document is its own root and has the hash of nothing as proof. An empty table gives no
    rows. Other columns are ignored. Texts of any length are hashed whole.
    """
    trees, top, names = _manifest(docs, run_levels)
    roots = top[-1].select("tree", F.col("run").alias("number"), F.lit(b"").alias("path"),
                           F.lit(None).cast("binary").alias("subroot"), "root")
    of_names = _paths(top[0], _ways_down(top, roots, run_levels), run_levels)
    subroots = (names.select("tree", "number", "name", F.col("leaf").alias("subroot"))
                .join(of_names.drop("subroot"), ["tree", "number"])
                .select(F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("number"),
                        "path", "subroot", "root"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield documents_of(row)

    def documents_of(row: dict) -> pa.RecordBatch:
        height, leaves, log = _levels_here(row["total"], run_levels), row["leaves"], row["log"]
        originals, proofs, folded = [], [], []
        further: dict[bytes, bytes] = {}     # from this run's root upwards: mostly the same
        for k in range(leaves):
            at = place(0, k, leaves, height) * DIGEST
            originals.append(log[at:at + DIGEST])
            path = path_in_log(log, k, leaves, height)
            proofs.append(proof_of(path + row["path"]))
            so_far = fold(row["tampered"][k] or originals[k], path)
            if so_far not in further:
                further[so_far] = fold(so_far, row["path"])
            folded.append(further[so_far])
        return pa.RecordBatch.from_arrays(
            [pa.array(row["ids"], pa.int64()), pa.array([d.hex() for d in originals]),
             pa.array([row["subroot"].hex()] * leaves), pa.array([row["root"].hex()] * leaves),
             pa.array(proofs), pa.array([d.hex() for d in folded]),
             pa.array([d == row["root"] for d in folded])],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return (_with_way_up(trees[0], _ways_down(trees, subroots, run_levels))
            .mapInArrow(check, SCHEMA))


def postorder_log(docs: DataFrame, run_levels: int = RUN_LEVELS) -> DataFrame:
    """Every node: tree, level, number on its level, place in its tree's postorder, digest.

    Trees are named "=" and the language, "" for documents without, and ``top`` over all.
    Nulls, repeated rows and empty tables are as in ``verify``.
    """
    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                height, leaves = _levels_here(row["total"], run_levels), row["leaves"]
                base, full = row["level"], row["full"]
                found = []
                # The leaves of a later round are the roots of the one before.
                for level in range(1 if base else 0, height + 1):
                    first = row["run"] << (run_levels - level)
                    for k in range(-(-leaves >> level)):
                        at = place(level, k, leaves, height) * DIGEST
                        found.append((base + level, first + k,
                                      place(base + level, first + k, full, height_of(full)),
                                      row["log"][at:at + DIGEST].hex()))
                columns = list(zip(*found)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * len(found), pa.string()),
                     pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.string())],
                    ["tree", "level", "number", "place", "digest"])

    trees, top, _ = _manifest(docs, run_levels)
    parts = [logs.mapInArrow(nodes, "tree string, level int, number bigint, place bigint, "
                                    "digest string") for logs in (*trees, *top)]
    return reduce(DataFrame.unionByName, parts)


def _field_sql(name: str) -> str:
    return (f"(case when {name} is null then '-' else strlen({name}::varchar)::varchar || ':' || "
            f"{name}::varchar end)")


def _leaf_sql(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(map(_field_sql, fields)) + ")"


#: The tree level by level, and every leaf's way up it, as recursive queries. The checksum works
#: through the bytes of an id, eight shifts each.
ORACLE_SQL = """
with recursive docs as (
    select row_number() over () as rid, doc_id, coalesce('=' || lang, '') as tree,
        {leaf} as leaf, {changed} as changed
    from documents),
crc as (
    select rid, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''),
                                                        lambda c: ascii(c)::bigint)),
        lambda acc, byte: list_reduce(
            list_prepend(xor(acc, byte), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
            lambda x, _: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint)
                         else x // 2 end)), 4294967295::bigint) as crc
    from docs where doc_id is not null),
placed as (
    select d.*, case when crc % 7 = 0 then changed else leaf end as shown,
        row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx,
        count(*) over (partition by tree) as n
    from docs d left join crc using (rid)),
nodes(tree, level, idx, h, n) as (
    select tree, 0, idx, leaf, n from placed
    union all
    select tree, level + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (n + 1) // 2
    from nodes where n > 1 group by tree, level, idx // 2, n),
subroots as (
    select tree, level as height, h as subroot, row_number() over (order by tree) - 1 as place,
        count(*) over () as trees
    from nodes where n = 1),
tops(level, idx, h, n) as (
    select 0, place, subroot, trees from subroots
    union all
    select level + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (n + 1) // 2
    from tops where n > 1 group by level, idx // 2, n),
root as (select h as root, level as height from tops where n = 1),
below(rid, tree, level, idx, d, path) as (
    select rid, tree, 0, idx, shown, '' from placed
    union all
    select f.rid, f.tree, f.level + 1, f.idx // 2,
        sha256(case when s.h is null then f.d when s.idx < f.idx then s.h || f.d
               else f.d || s.h end), f.path || coalesce(s.h, '')
    from below f join subroots t on t.tree = f.tree and f.level < t.height
        left join nodes s on s.tree = f.tree and s.level = f.level and s.idx = xor(f.idx, 1)),
above(rid, level, idx, d, path) as (
    select b.rid, 0, t.place, b.d, b.path
    from below b join subroots t on t.tree = b.tree and b.level = t.height
    union all
    select f.rid, f.level + 1, f.idx // 2,
        sha256(case when s.h is null then f.d when s.idx < f.idx then s.h || f.d
               else f.d || s.h end), f.path || coalesce(s.h, '')
    from above f join root r on f.level < r.height
        left join tops s on s.level = f.level and s.idx = xor(f.idx, 1))
select p.doc_id, p.leaf, t.subroot, r.root, sha256(a.path) as proof_sha256,
    a.d as folded_root, a.d = r.root as verified
from placed p join subroots t using (tree), root r join above a on a.level = r.height
where a.rid = p.rid
""".replace("{leaf}", _leaf_sql("n_chars")).replace(
    "{changed}", _leaf_sql("(n_chars::hugeint + 1)"))
