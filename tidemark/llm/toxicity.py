"""Toxicity scores from averaged subword embeddings under a linear softmax.

A word is the bag of its character n-grams (three to five bytes, with its edges marked), hashed
into a table of embeddings. A window of words is the mean of its n-grams' embeddings, and a
linear softmax over two classes scores it; a document scores as its worst window, so that a few
toxic words in a long text are not averaged away. Embeddings and softmax are trained together in
numpy on a bounded sample of labelled documents. A misspelling that was never seen shares most of
its n-grams with the word it comes from.

Under a linear output an n-gram's embedding only acts through one number, so scoring reads a
table of ``2 ** GRAM_BITS`` numbers: that, and nothing that grows, is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, id_and_text, training_labels
from tidemark.llm.textbytes import LOWER, grouped, spread, word_hashes, words

GRAM_BITS, DIMENSIONS = 16, 8
GRAM_SIZES = (3, 4, 5)
WINDOW, STRIDE = 16, 8
#: Labelled documents per class that are fitted on, at most.
TRAIN_ROWS = 3000
FLAG_FROM = 0.3
SEED = 7

_APART = np.zeros(256, bool)
_APART[[b for b in range(128) if not (chr(b).isalnum() or chr(b) in "@$!*'")]] = True


class Grams(NamedTuple):
    buckets: np.ndarray      # of all n-grams, word after word
    first: np.ndarray        # per word, and once behind the last: its first n-gram


def word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Grams:
    """Buckets of all n-grams of the given words; every word has at least one."""
    sizes = ends - starts + 2
    first = np.r_[0, np.cumsum(sizes)]
    padded = LOWER[data[np.clip(spread(starts - 1, sizes), 0, max(len(data) - 1, 0))]
                   ].astype(np.uint32)
    padded[first[:-1]] = 32
    padded[first[1:] - 1] = 32
    left = np.repeat(first[1:], sizes) - np.arange(len(padded))
    longest = GRAM_SIZES[-1]
    padded = np.r_[padded, np.zeros(longest, np.uint32)]
    hashes = np.full(len(left), 2166136261, np.uint32)
    buckets = np.empty((len(left), len(GRAM_SIZES)), np.uint32)
    for k in range(longest):
        hashes = (hashes ^ padded[k:k + len(left)]) * np.uint32(16777619)
        if k + 1 in GRAM_SIZES:
            spun = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(2246822519)
            buckets[:, GRAM_SIZES.index(k + 1)] = spun >> np.uint32(32 - GRAM_BITS)
    there = left[:, None] >= np.array(GRAM_SIZES)
    counts = np.add.reduceat(there.sum(1), first[:-1]) if len(sizes) else np.zeros(0, int)
    return Grams(buckets[there], np.r_[0, np.cumsum(counts)])


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and word count of each window, and each row's first window.

    A row with words has a window every ``STRIDE`` words up to one that reaches its end.
    """
    counts = np.diff(first)
    per_row = np.where(counts > 0, 1 + np.maximum(-(-(counts - WINDOW) // STRIDE), 0), 0)
    steps = spread(np.zeros(len(counts), np.int64), per_row)
    starts = np.repeat(first[:-1], per_row) + steps * STRIDE
    sizes = np.minimum(WINDOW, np.repeat(first[1:], per_row) - starts)
    return starts, sizes, np.r_[0, np.cumsum(per_row)]


def worst_windows(first: np.ndarray, sums: np.ndarray, counts: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows with words, their highest window mean, and that window's words.

    ``sums`` and ``counts`` hold each word's summed n-gram numbers and their count.
    """
    starts, sizes, heads = windows(first)
    rows = np.flatnonzero(np.diff(heads))
    if not len(rows):
        empty = np.zeros(0, np.int64)
        return rows, np.zeros(0), empty, empty
    total, number = np.r_[0, np.cumsum(sums)], np.r_[0, np.cumsum(counts)]
    mean = ((total[starts + sizes] - total[starts])
            / (number[starts + sizes] - number[starts]))
    best = np.maximum.reduceat(mean, heads[:-1][rows])
    at = np.flatnonzero(mean == np.repeat(best, np.diff(heads)[rows]))
    _, pick = np.unique(np.searchsorted(heads, at, side="right"), return_index=True)
    at = at[pick]                                  # the first window among equals
    return rows, best, starts[at], sizes[at]


class ToxicityModel(NamedTuple):
    table: np.ndarray        # per n-gram bucket: its embedding along the softmax difference
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for low, _, data, offsets in grouped(column):
            found = words(data, offsets, _APART)
            if not len(found.starts):
                continue
            grams = word_grams(data, found.starts, found.ends)
            sums = np.add.reduceat(self.table[grams.buckets], grams.first[:-1],
                                   dtype=np.float64)
            rows, best, *_ = worst_windows(found.first, sums, np.diff(grams.first))
            out[low + rows] = best
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -30, 30)))


def first_guess(pairs: np.ndarray, kinds: int, toxic: np.ndarray, grams: Grams) -> np.ndarray:
    """Smoothed log odds of each n-gram over the distinct words of the documents.

    It only says which windows to look at first; the trained numbers replace it. ``pairs`` are
    the distinct (row, word) pairs as ``row * kinds + word``.
    """
    row, kind = np.divmod(pairs, kinds)
    per_gram = []
    for label in (1, 0):
        of_word = np.bincount(kind[toxic[row] == label], minlength=kinds)
        of_gram = np.bincount(grams.buckets, np.repeat(of_word, np.diff(grams.first)),
                              1 << GRAM_BITS)
        per_gram.append(of_gram / max((toxic == label).sum(), 1))
    rare = 5 / max(len(toxic), 1)
    return np.log((per_gram[0] + rare) / (per_gram[1] + rare))


def without_evidence(share: float) -> ToxicityModel:
    """Scores every text with the share of class 1."""
    return ToxicityModel(np.zeros(1 << GRAM_BITS), float(np.log(share / (1 - share))))


def lexicon(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Grams]:
    """Number of each word among the distinct ones, each row's first word, and the n-grams of
    the distinct words. Texts are hashed some megabytes at a time."""
    hashes, counts, known, letters, sizes = [], [np.zeros(1, np.int64)], [], [], []
    for _, _, data, offsets in grouped(texts):
        data = LOWER[data]
        found = words(data, offsets, _APART)
        hashes.append(word_hashes(data, found))
        counts.append(np.diff(found.first))
        fresh, at = np.unique(hashes[-1], return_index=True)
        known.append(fresh)
        sizes.append((found.ends - found.starts)[at])
        letters.append(data[spread(found.starts[at], sizes[-1])])
    if not hashes:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), Grams(
            np.zeros(0, np.uint32), np.zeros(1, np.int64))
    names, pick = np.unique(np.concatenate(known), return_index=True)
    ends = np.cumsum(np.concatenate(sizes))
    grams = word_grams(np.concatenate(letters), (ends - np.concatenate(sizes))[pick], ends[pick])
    kind_of = np.concatenate([np.searchsorted(names, part).astype(np.int32) for part in hashes])
    return kind_of, np.cumsum(np.concatenate(counts)), grams


def fit(texts: pa.Array, labels: np.ndarray, share: float, rounds: int = 20, steps: int = 25,
        rate: float = 0.1, decay: float = 3e-6, seed: int = SEED) -> ToxicityModel:
    """Train embeddings and softmax together; each round picks every row's worst window anew.

    Gradient steps have momentum and one step size for a whole matrix: sizes per entry would
    let n-grams that occur once move as far as common ones. ``share`` is the share of class 1
    among all labels; the bias is moved to it at the end.
    """
    rng = np.random.default_rng(seed)
    kind_of, first, grams = lexicon(texts)
    per_kind = np.diff(grams.first)
    counts = per_kind[kind_of]
    number = np.r_[0, np.cumsum(counts, dtype=np.int64)]
    row_of = np.repeat(np.arange(len(texts)), np.diff(first))
    kinds = len(per_kind)
    rows = np.flatnonzero(np.diff(first))
    y = labels[rows].astype(float)
    if len(np.unique(y)) < 2:
        return without_evidence(share)
    table = first_guess(np.unique(row_of * kinds + kind_of), kinds, labels, grams)
    del row_of
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)

    embed = rng.normal(0, 0.01, (1 << GRAM_BITS, DIMENSIONS))
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2))
    offset = np.zeros(2)
    speed = [np.zeros_like(p) for p in (embed, softmax, offset)]
    for _ in range(rounds):
        sums = np.add.reduceat(table[grams.buckets], grams.first[:-1])[kind_of]
        _, _, starts, sizes = worst_windows(first, sums, counts)
        picked = kind_of[spread(starts, sizes)]
        places = grams.buckets[spread(grams.first[picked], per_kind[picked])]
        bag = number[starts + sizes] - number[starts]
        heads = np.cumsum(bag) - bag
        owner = np.repeat(np.arange(len(rows)), bag)
        used, place_of = np.unique(places, return_inverse=True)
        for _ in range(steps):
            line = softmax[:, 1] - softmax[:, 0]
            mean = np.column_stack([np.add.reduceat(line_of[places], heads)
                                    for line_of in np.ascontiguousarray(embed.T)]) / bag[:, None]
            logits = mean @ softmax + offset
            p = 1 / (1 + np.exp(-np.clip(logits[:, 1] - logits[:, 0], -30, 30)))
            error = (p - y) * weight / len(y)
            per_gram = np.bincount(place_of, (error / bag)[owner], len(used))
            slope = decay * embed
            slope[used] += per_gram[:, None] * line
            slopes = (slope, np.outer(mean.T @ error, [-1, 1]),
                      np.array([-error.sum(), error.sum()]))
            for parameter, grad, move, factor in zip((embed, softmax, offset), slopes, speed,
                                                     (1000 * rate, rate, rate)):
                move *= 0.9
                move -= factor * grad
                parameter += move
        table = embed @ (softmax[:, 1] - softmax[:, 0])
    shift = np.log(share / (1 - share))            # classes weighed the same while fitting
    return ToxicityModel(table, float(offset[1] - offset[0] + shift))


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = TRAIN_ROWS,
          seed: int = SEED) -> ToxicityModel:
    """Fit on at most ``rows_per_class`` labelled documents of each class.

    With labels of one class only, or none, every score is the smoothed share of class 1.
    """
    sample = training_labels(labels, "toxic", rows_per_class, seed)
    shares = {row["label"]: row["count"] for row in
              labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
              .where(~held_out()).groupBy(F.col("toxic").cast("int").alias("label"))
              .count().collect()}
    share = (shares.get(1, 0) + 1) / (sum(shares.values()) + 2)
    # Arrow rows, put in order by id, so that a fit can be repeated.
    rows = (id_and_text(docs).join(F.broadcast(sample), "doc_id")
            .select("doc_id", "label", "text").toArrow()
            .sort_by([("doc_id", "ascending"), ("text", "ascending"), ("label", "ascending")]))
    return fit(rows.column("text").combine_chunks(), rows.column("label").to_numpy(), share,
               seed=seed)


def score(docs: DataFrame, model: ToxicityModel, flag_from: float = FLAG_FROM) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Texts without words (null, empty, white space) score as a window of no evidence; repeated
    rows are scored each; other columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sent.value.scores(batch.column("text")))],
                ["doc_id", "score"])

    return (id_and_text(docs).mapInArrow(run, "doc_id bigint, score double")
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= flag_from).cast("int").alias("predicted")))
