"""Whitening of vectors through distributed block matrices.

Valid vectors become whole numbers, are centred on their exact mean and packed into the row
blocks of a BlockMatrix. Its transpose times itself is the scatter; a local eigendecomposition of
that small matrix gives the whitening matrix; a second BlockMatrix product projects all rows.
Each row's id and its exact squared distance travel through the products in columns of their own,
cut into halves that doubles hold exactly, so projected rows need not be joined back.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.session import materialise

#: Entries are counted in steps of 1/64. The origin of 1,000,000 that the whole numbers start
#: from goes away when they are centred, so it is never added.
STEPS = 64
#: Rows of one block at most: 2 MB at 64 dimensions. Only block numbers reach the driver.
BLOCK_ROWS = 4096
#: A task of a product holds this many blocks of each side.
BLOCKS_A_TASK = 16
#: Eigenvalues up to this share of the largest are rounding noise: no spread in that direction.
NO_SPREAD = 1e-13
COMPONENTS = 32
#: What a row carries: its id and squared distance in halves, and what kind of row it is.
_CARRIED = 5
_PADDING, _WITH_ID, _WITHOUT_ID = 0.0, 1.0, 2.0
#: Squares and products must stay below this to be exact in longs.
_LIMIT = 2.0 ** 62
_MERGES = 16

_BLOCKS = StructType([
    StructField("at", StructType([StructField("row", LongType()), StructField("col", LongType())])),
    StructField("block", MatrixUDT())])
SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
          "explained double, identity_error double")


class Fit(NamedTuple):
    """Whitening fitted on ``n`` vectors; one column of ``matrix`` per component."""

    n: int
    sums: np.ndarray            # exact sums of the steps per dimension
    values: np.ndarray          # eigenvalues, falling
    matrix: np.ndarray          # unit eigenvectors, each over the root of its eigenvalue
    explained: np.ndarray       # eigenvalues over the trace


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and ``steps``, floor(64 * entry) per entry, of the vectors that can be used."""
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c)
                   | (F.abs(c.cast("double")) == float("inf")))
    usable = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(~bad)
    length = (usable.groupBy(F.size("embedding").alias("length")).count()
              .orderBy(F.desc("count"), F.desc("length")).first())
    return (usable.where(F.size("embedding") == (length["length"] if length else 0))
            .select(F.col("vec_id").cast("bigint").alias("vec_id"),
                    F.transform("embedding", lambda c: F.floor(c.cast("double") * STEPS))
                    .alias("steps")))


def packed(rows: DataFrame) -> DataFrame:
    """The vectors in lists of up to a block's rows, numbered by task and place, written once.

    Every later product reads these lists, so a row has the same place in all of them, whatever
    tasks are run again.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, waiting, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            while size >= BLOCK_ROWS:
                table = pa.Table.from_batches(waiting)
                yield listed(part, chunk, table.slice(0, BLOCK_ROWS))
                waiting, size = table.slice(BLOCK_ROWS).to_batches(), size - BLOCK_ROWS
                chunk += 1
        if size:
            yield listed(part, chunk, pa.Table.from_batches(waiting))

    def listed(part: int, chunk: int, table: pa.Table) -> pa.RecordBatch:
        ids = table.column("vec_id").combine_chunks()
        steps = table.column("steps").combine_chunks().flatten()
        return pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([chunk]),
             pa.ListArray.from_arrays([0, len(ids)], ids),
             pa.ListArray.from_arrays([0, len(steps)], steps)], ["part", "chunk", "ids", "steps"])

    return materialise(rows.mapInArrow(
        pack, "part bigint, chunk bigint, ids array<bigint>, steps array<bigint>"))


def _steps(batch: pa.RecordBatch, k: int) -> tuple[pa.Array, np.ndarray]:
    ids = batch.column("ids")[k].values
    steps = batch.column("steps")[k].values.to_numpy()
    return ids, steps.reshape(len(ids), -1)


class Layout(NamedTuple):
    """How the packed lists become blocks of equal height."""

    firsts: dict[int, int]      # number of the first block per task that packed lists
    blocks: int
    height: int                 # rows of the longest list, so few short lists stay small blocks


def _totals(lists: DataFrame) -> tuple[int, np.ndarray, Layout]:
    """Rows, exact sums per dimension, and the layout of the blocks."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = 0, None
        for batch in batches:
            for k in range(batch.num_rows):
                ids, steps = _steps(batch, k)
                if np.abs(steps.astype(float)).sum() + rows > _LIMIT:
                    raise OverflowError("sums of the vectors do not fit longs")
                rows += len(ids)
                sums = steps.sum(0) + (0 if sums is None else sums)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows]), pa.array([sums.tolist()])], ["rows", "sums"])

    # One row per task, and one number per task that packed the lists.
    parts = lists.mapInArrow(add, "rows bigint, sums array<bigint>").collect()
    firsts, blocks, height = {}, 0, 0
    for r in lists.groupBy("part").agg(F.count("*").alias("lists"),
                                       F.max(F.size("ids")).alias("height")).collect():
        firsts[r["part"]] = blocks
        blocks, height = blocks + r["lists"], max(height, r["height"])
    return (sum(r["rows"] for r in parts),
            np.sum([r["sums"] for r in parts], axis=0, dtype=np.int64),
            Layout(firsts, blocks, height))


def _block_matrix(lists: DataFrame, n: int, sums: np.ndarray, layout: Layout,
                  across: int) -> BlockMatrix:
    """Centred rows and what they carry, ``across`` blocks side by side in a row of blocks.

    The last block of a task ends in rows of zeros, which add nothing to the scatter.
    """
    dims, height = len(sums), layout.height
    width = dims + _CARRIED

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                number = (layout.firsts[batch.column("part")[k].as_py()]
                          + batch.column("chunk")[k].as_py())
                yield matrix_row(number // across, number % across, block(*_steps(batch, k)))

    def block(ids: pa.Array, steps: np.ndarray) -> np.ndarray:
        out = np.zeros((height, width))
        filled = out[:len(ids)]
        if np.abs(steps).max() * float(n) > _LIMIT:
            raise OverflowError("n * x does not fit a long")
        apart = steps * np.int64(n) - sums
        if np.square(apart.astype(float)).sum(1).max() > _LIMIT:
            raise OverflowError("the deviation does not fit a long")
        deviation = np.square(apart).sum(1)
        filled[:, :dims] = apart / np.float64(n)
        numbers = ids.fill_null(0).to_numpy()
        filled[:, dims], filled[:, dims + 1] = numbers >> 32, numbers & 0xFFFFFFFF
        filled[:, dims + 2], filled[:, dims + 3] = deviation >> 32, deviation & 0xFFFFFFFF
        filled[:, dims + 4] = np.where(ids.is_null().to_numpy(zero_copy_only=False),
                                       _WITHOUT_ID, _WITH_ID)
        return out

    def matrix_row(row: int, col: int, values: np.ndarray) -> pa.RecordBatch:
        none = pa.array([None], pa.list_(pa.int32()))
        at = pa.StructArray.from_arrays([pa.array([row]), pa.array([col])], ["row", "col"])
        stored = pa.StructArray.from_arrays(
            [pa.array([1], pa.int8()), pa.array([height], pa.int32()),
             pa.array([width], pa.int32()), none, none,
             pa.ListArray.from_arrays([0, values.size], pa.array(values.ravel("F"))),
             pa.array([False])],
            ["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"])
        return pa.RecordBatch.from_arrays([at, stored], ["at", "block"])

    down = -(-layout.blocks // across)
    stored = callMLlibFunc("createBlockMatrix", lists.mapInArrow(fill, _BLOCKS),
                           height, width, down * height, across * width)
    return BlockMatrix(stored, height, width)


def _scatter(tall: BlockMatrix, blocks: int) -> np.ndarray:
    """Transpose times matrix; the blocks are added up in parts before they meet."""
    stored = tall._java_matrix_wrapper._java_model
    flat = tall.transpose()._java_matrix_wrapper.call(
        "multiply", stored, -(-blocks // BLOCKS_A_TASK))
    return BlockMatrix(flat, tall.colsPerBlock, tall.colsPerBlock).toLocalMatrix().toArray()


def _fit(scatter: np.ndarray, n: int, sums: np.ndarray, components: int) -> Fit:
    covariance = (scatter + scatter.T) / (2.0 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int((values > max(values[0], 0.0) * NO_SPREAD).sum()))
    return Fit(n, sums, values[:kept], vectors[:, :kept] / np.sqrt(values[:kept]),
               values[:kept] / np.trace(covariance))


def _projected(spark: SparkSession, wide: BlockMatrix, fit: Fit, blocks: int, across: int
               ) -> DataFrame:
    """Blocks of whitened rows: every block column meets its own copy of the whitening matrix.

    Blocks lie in a square grid because a product deals out rows and columns of blocks by the
    root of its number of tasks each; a single column of blocks would crowd into few tasks.
    """
    dims, kept = fit.matrix.shape
    turn = np.zeros((dims + _CARRIED, kept + _CARRIED))
    turn[:dims, :kept] = fit.matrix
    turn[dims:, kept:] = np.eye(_CARRIED)
    values = turn.ravel("F").tolist()
    # The number of tasks of a product is the larger one of its sides'.
    copies = (spark.sparkContext.parallelize(range(across), -(-blocks // BLOCKS_A_TASK))
              .map(lambda k: ((k, k), DenseMatrix(*turn.shape, values))))
    turns = callMLlibFunc("createBlockMatrix", spark.createDataFrame(copies, _BLOCKS),
                          *turn.shape, across * turn.shape[0], across * turn.shape[1])
    return callMLlibFunc("getMatrixBlocks",
                         wide.multiply(BlockMatrix(turns, *turn.shape))
                         ._java_matrix_wrapper._java_model)


def _real_rows(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    for stored in batch.column(1):
        values = stored["values"].values.to_numpy().reshape(width, -1).T
        yield values[values[:, -1] != _PADDING]


def _identity_error(blocks: DataFrame, kept: int) -> float:
    """Largest entry of the whitened rows' covariance less the identity.

    Every task centres its own rows; parts are merged with the distance of their means.
    """
    def merge(parts: Iterator[tuple[float, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows, mean, spread = 0.0, np.zeros(kept), np.zeros((kept, kept))
        for count, other, added in parts:
            if count:
                apart = other - mean
                spread += added + np.outer(apart, apart) * (rows * count / (rows + count))
                mean = mean + apart * (count / (rows + count))
                rows += count
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows]), pa.array([mean.tolist()]), pa.array([spread.ravel().tolist()])],
                ["n", "mean", "spread"])

    def of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                for rows in _real_rows(batch, kept + _CARRIED):
                    if len(rows):
                        mean = rows[:, :kept].mean(0)
                        apart = rows[:, :kept] - mean
                        yield float(len(rows)), mean, apart.T @ apart
        yield from merge(parts())

    def stored(batch: pa.RecordBatch):
        for r in batch.to_pylist():
            yield r["n"], np.array(r["mean"]), np.array(r["spread"]).reshape(kept, kept)

    def of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from merge(part for batch in batches for part in stored(batch))

    schema = "n double, mean array<double>, spread array<double>"
    merged = (blocks.mapInArrow(of_blocks, schema).repartition(_MERGES)
              .mapInArrow(of_parts, schema).toArrow())
    last = next(merge(part for batch in merged.to_batches() for part in stored(batch)))
    rows, spread = last.column("n")[0].as_py(), np.array(last.column("spread")[0].as_py())
    return float(np.abs(spread.reshape(kept, kept) / rows - np.eye(kept)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates: one row per usable vector and component, by falling eigenvalue.

    Columns: vec_id, component (from 1), n (vectors fitted on), deviation (sum over dimensions
    of (n * x - S)^2, exact, where x are the whole numbers and S their sums), whitened (x - S / n
    on the component, over the root of its eigenvalue), explained (eigenvalue over trace),
    identity_error (largest entry of the covariance of ``whitened`` less the identity).

    Vectors that are null, empty or hold a null or non-finite entry are dropped, as are those of
    another length than the most frequent one (of equally frequent ones the longest). Directions
    without spread have no component, so equal vectors, a single vector and an empty table give
    no rows. Repeated rows and ids count and come out each; a null vec_id stays null. Other
    columns are ignored. Entries so large that exact sums leave the range of a long raise
    OverflowError, and so does a deviation beyond it. Which sign a component has is arbitrary but
    the same for all rows.
    """
    spark = vectors.sparkSession
    lists = packed(whole_vectors(vectors))
    n, sums, layout = _totals(lists) if lists.head(1) else (0, None, None)
    if not n:
        return spark.createDataFrame([], SCHEMA)
    tall = _block_matrix(lists, n, sums, layout, 1)
    scatter = _scatter(tall, layout.blocks)[:len(sums), :len(sums)]
    fit = _fit(scatter, n, sums, components)
    kept = len(fit.values)
    if not kept:
        return spark.createDataFrame([], SCHEMA)
    across = isqrt(layout.blocks - 1) + 1
    wide = _block_matrix(lists, n, sums, layout, across)
    projected = _projected(spark, wide, fit, layout.blocks, across)
    error = _identity_error(projected, kept)

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _real_rows(batch, kept + _CARRIED):
                whole = rows[:, kept:kept + 4].astype(np.int64)
                ids, deviation = whole[:, 0] << 32 | whole[:, 1], whole[:, 2] << 32 | whole[:, 3]
                ids = pa.array(ids, mask=rows[:, -1] == _WITHOUT_ID)
                each = np.repeat(np.arange(len(rows)), kept)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(each)),
                     pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(each), n)), pa.array(deviation[each]),
                     pa.array(np.ascontiguousarray(rows[:, :kept]).ravel()),
                     pa.array(np.tile(fit.explained, len(rows))),
                     pa.array(np.full(len(each), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error"])

    return projected.mapInArrow(spread_out, SCHEMA)
