"""Quality scores from random-indexing word vectors and a small calibrated network.

Every token falls into one of ``2 ** TOKEN_BITS`` buckets and each bucket has a fixed sparse
random index vector. One pass over all documents adds, for each bucket, the index vectors of the
tokens next to its occurrences; Spark sums these per bucket. A document is the mean of its
tokens' vectors plus two pooled agreements between them. A network of two layers, fitted in
numpy on a bounded sample of labelled documents, turns that into a probability, whose temperature
is fitted on documents the network has not seen.

What is broadcast (vectors and network) has a fixed size, whatever the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, id_and_text, training_labels
from tidemark.llm.textbytes import (BYTE_VALUES, LOWER, Words, grouped, row_edges, running,
                                    span_hash)

TOKEN_BITS, DIMENSIONS, NONZERO = 14, 32, 4
FEATURES = DIMENSIONS + 2
#: Labelled documents per class that are fitted on, at most.
TRAIN_ROWS = 4000
KEEP_FROM = 0.7
SEED = 20240501

KIND = np.full(256, 2, np.uint8)                 # symbols
KIND[[32, 9, 10, 11, 12, 13]] = 0                # white space
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def index_vectors(seed: int = SEED) -> np.ndarray:
    """One ternary vector per bucket with ``NONZERO`` entries of +1 or -1."""
    rng = np.random.default_rng(seed)
    size = 1 << TOKEN_BITS
    places = np.argsort(rng.random((size, DIMENSIONS)), axis=1)[:, :NONZERO]
    out = np.zeros((size, DIMENSIONS), np.int8)
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.int8), places.shape), 1)
    return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every run of letters and digits or of symbols, and each row's first token."""
    kind = KIND[data]
    edge = row_edges(len(data), offsets)
    differs = np.ones(len(data) + 1, bool)
    differs[1:-1] = (kind[1:] != kind[:-1]) | edge[1:]
    starts = np.flatnonzero(differs[:-1] & (kind > 0))
    ends = np.flatnonzero(differs[1:] & (kind > 0)) + 1
    hashes = span_hash(running(BYTE_VALUES[0][LOWER[data]]), starts, ends)
    return ((hashes >> np.uint64(64 - TOKEN_BITS)).astype(np.uint16),
            np.searchsorted(starts, offsets))


def neighbour_sums(ids: np.ndarray, first: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each token the index vectors of the tokens before and after it in its row."""
    own = vectors[ids]
    out = np.zeros_like(own)
    if len(ids):
        out[1:] += own[:-1]
        out[:-1] += own[1:]
        heads = first[:-1][np.diff(first) > 0]
        heads = heads[heads > 0]
        out[heads] -= own[heads - 1]
        out[heads - 1] -= own[heads]
    return out


def context_vectors(docs: DataFrame, seed: int = SEED) -> np.ndarray:
    """Per bucket the summed neighbours over all documents, brought to length one.

    Each task adds up its own documents and emits one row per bucket, so what is shuffled does
    not depend on how often a token occurs; the collected table has a fixed number of rows.
    """
    names = [f"v{k}" for k in range(DIMENSIONS)]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = index_vectors(seed)
        sums = np.zeros((1 << TOKEN_BITS, DIMENSIONS), np.int64)
        for batch in batches:
            for _, _, data, offsets in grouped(batch.column("text")):
                ids, first = tokens(data, offsets)
                if not len(ids):
                    continue
                order = np.argsort(ids, kind="stable")
                ordered = ids[order]
                heads = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
                around = neighbour_sums(ids, first, vectors)[order]
                sums[ordered[heads]] += np.add.reduceat(around, heads, axis=0, dtype=np.int64)
        used = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), *(pa.array(sums[used, k]) for k in range(DIMENSIONS))],
            ["bucket", *names])

    schema = ", ".join(["bucket bigint", *(f"{n} bigint" for n in names)])
    rows = (id_and_text(docs).select("text").mapInArrow(gather, schema)
            .groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas())
    out = np.zeros((1 << TOKEN_BITS, DIMENSIONS))
    out[rows["bucket"].to_numpy(np.int64)] = rows[names].to_numpy(np.float64)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def word_vectors(contexts: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Context and index vector of each bucket, together of length one."""
    own = index_vectors(seed) / np.sqrt(NONZERO)
    both = contexts + own
    return (both / np.maximum(np.linalg.norm(both, axis=1, keepdims=True), 1e-9)
            ).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean vector, its length, mean agreement of adjacent tokens."""
    out = np.zeros((len(column), FEATURES), np.float32)
    for low, high, data, offsets in grouped(column):
        ids, first = tokens(data, offsets)
        counts = np.diff(first)
        rows = np.flatnonzero(counts)
        if not len(rows):
            continue
        own = vectors[ids]
        mean = np.add.reduceat(own, first[:-1][rows], axis=0) / counts[rows, None]
        agree = np.zeros(len(ids), np.float32)
        agree[1:] = np.einsum("ij,ij->i", own[1:], own[:-1])
        agree[first[:-1][rows]] = 0
        part = out[low:high]
        part[rows, :DIMENSIONS] = mean
        part[rows, DIMENSIONS] = np.linalg.norm(mean, axis=1)
        part[rows, DIMENSIONS + 1] = (np.add.reduceat(agree, first[:-1][rows])
                                      / np.maximum(counts[rows] - 1, 1))
    return out


class Network(NamedTuple):
    """Standardisation, two layers and the temperature of the probabilities."""

    centre: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        layer = np.tanh((features - self.centre) / self.scale @ self.hidden + self.hidden_bias)
        return layer @ self.out + self.out_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(features) / self.temperature, -30, 30)
        return 1 / (1 + np.exp(-z))


def fit_network(features: np.ndarray, labels: np.ndarray, weights: np.ndarray,
                width: int = 32, epochs: int = 60, seed: int = SEED) -> Network:
    """Adam on weighted log loss with four fifths of the rows; temperature on the rest."""
    rng = np.random.default_rng(seed)
    features = features.astype(np.float64)
    order = rng.permutation(len(labels))
    fit, check = order[len(order) // 5:], order[:len(order) // 5]
    centre = features[fit].mean(0)
    scale = features[fit].std(0) + 1e-6
    theta = [rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, width)), np.zeros(width),
             rng.normal(0, 1 / np.sqrt(width), width), np.zeros(1)]
    first = [np.zeros_like(p) for p in theta]
    second = [np.zeros_like(p) for p in theta]
    step = 0
    for _ in range(epochs):
        rng.shuffle(fit)
        for at in range(0, len(fit), 128):
            rows = fit[at:at + 128]
            x = (features[rows] - centre) / scale
            layer = np.tanh(x @ theta[0] + theta[1])
            p = 1 / (1 + np.exp(-np.clip(layer @ theta[2] + theta[3], -30, 30)))
            error = (p - labels[rows]) * weights[rows] / len(rows)
            back = error[:, None] * theta[2] * (1 - layer ** 2)
            slopes = [x.T @ back + 1e-4 * theta[0], back.sum(0),
                      layer.T @ error + 1e-4 * theta[2], np.array([error.sum()])]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope ** 2
                theta[k] = theta[k] - 0.005 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(centre, scale, theta[0], theta[1], theta[2], float(theta[3][0]), 1.0)
    if not len(check):
        return net
    z, y, w = net.logits(features[check]), labels[check], weights[check]

    def loss(temperature: float) -> float:
        return float((w * np.logaddexp(0, np.where(y == 1, -z, z) / temperature)).sum())

    return net._replace(temperature=min(np.geomspace(0.25, 8, 61), key=loss))


class QualityModel(NamedTuple):
    vectors: np.ndarray
    network: Network | None      # None: no label to learn from
    base_rate: float


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = TRAIN_ROWS,
          seed: int = SEED) -> QualityModel:
    """Word vectors from all documents, network from at most ``2 * rows_per_class`` of them.

    Where one class has more labels than that, rows are weighted back to the share of their
    class. With labels of one class only, every score is that class's smoothed share; with none,
    0.5.
    """
    vectors = word_vectors(context_vectors(docs, seed), seed)
    sample = training_labels(labels, "quality", rows_per_class, seed)
    shares = {row["label"]: row["count"] for row in
              labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
              .where(~held_out()).groupBy(F.col("quality").cast("int").alias("label"))
              .count().collect()}
    total = sum(shares.values())
    base = (shares.get(1, 0) + 1) / (total + 2)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pooled(batch.column("text"), sent.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array(list(got.astype(np.float64)), pa.list_(pa.float64()))],
                ["doc_id", "label", "features"])

    rows = (id_and_text(docs).join(F.broadcast(sample), "doc_id")
            .select("doc_id", "text", "label")
            .mapInArrow(features, "doc_id bigint, label int, features array<double>")
            .toPandas())
    if rows.empty or rows["label"].nunique() < 2:
        return QualityModel(vectors, None, base)
    # Shuffles return rows in any order: fix it, so that a fit can be repeated.
    table = np.column_stack([rows["doc_id"], rows["label"], np.stack(rows["features"])])
    table = table[np.lexsort(table.T[::-1])]
    y = table[:, 1]
    seen = np.array([(y == 0).sum(), (y == 1).sum()], float)
    wanted = np.array([shares.get(0, 0), shares.get(1, 0)], float) / max(total, 1)
    weights = (wanted * len(y) / seen)[y.astype(int)]
    return QualityModel(vectors, fit_network(table[:, 2:], y, weights, seed=seed), base)


def score(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Texts without tokens (null, empty, white space) are scored from all-zero features; repeated
    rows are scored each; other columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network, base = sent.value
        for batch in batches:
            column = batch.column("text")
            scores = (np.full(len(column), base) if network is None
                      else network.scores(pooled(column, vectors)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return (id_and_text(docs).mapInArrow(run, "doc_id bigint, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= keep_from).cast("int").alias("predicted")))


def accepted(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """The documents, all columns, whose score reaches ``keep_from``.

    All of them where labels gave no network: one score for all tells no document from another.
    """
    if model.network is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network, _ = sent.value
        for batch in batches:
            scores = network.scores(pooled(batch.column("text"), vectors))
            yield batch.filter(pa.array(scores >= keep_from))

    return docs.mapInArrow(run, schema)
