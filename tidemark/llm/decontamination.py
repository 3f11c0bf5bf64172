"""Benchmark passages in documents, found by their rare words and checked word by word.

An item of a length class is looked for in overlapping windows of that class. A window is a leak
if the longest common subsequence covers three quarters of the item's words, or three fifths where
the item's answer (what follows an answer mark, else its last sentence) is there as well, as in a
paraphrase. Either takes three fifths of the item's words, so a window must hold some of the
item's rarest ones: those that do are candidates, and no other window can be a leak.

Each leak is given its cosine in a latent space: items are TF-IDF vectors, with document
frequencies counted over all passages of all documents, and a randomised SVD, whose products are
summed by Spark over the items, gives the space. The cosine decides nothing.

Documents are never shuffled: items go to them. Items are taken in blocks of at most
``ITEM_BLOCK``, which bounds what is broadcast; a larger benchmark takes more passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text
from tidemark.llm.quality_classifier import KIND
from tidemark.llm.textbytes import (LOWER, grouped, row_groups, spread, text_buffer, word_hashes,
                                    words)

TABLE_BITS = 20
ITEM_BLOCK = 20_000
PASSAGE = 32
RANK, OVERSAMPLE, POWER_STEPS = 128, 16, 2
LCS_ALONE, LCS_WITH_ANSWER, ANSWER_SHARE = 0.75, 0.6, 0.8
#: Pieces in a window, and the share of an item's words that must be among its rarest ones there.
PIECES, RARE_SHARE = 4, 0.25
#: Pairs of words and items that are held at once.
PAIRS = 1 << 22
SEED = 5

_APART = KIND != 1


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of letters and digits, A-Z lower-cased) and each row's first."""
    data, offsets = text_buffer(column)
    data = LOWER[data]
    found = words(data, offsets, _APART)
    return word_hashes(data, found), found.first


class Item(NamedTuple):
    item_id: int
    terms: np.ndarray        # word hashes, in order
    answer: np.ndarray       # those of the answer part


def answer_part(text: str) -> str:
    """What follows the last answer mark; without one, the last sentence with a few words."""
    for mark in ("answer:", "respuesta:", "antwort:", "réponse:"):
        at = text.lower().rfind(mark)
        if at >= 0 and text[at + len(mark):].strip():
            return text[at + len(mark):]
    sentences = [s for s in text.replace("?", ".").replace("!", ".").split(".")
                 if len(s.split()) >= 3]
    return sentences[-1] if sentences else text


def read_items(benchmark: DataFrame) -> list[Item]:
    rows = benchmark.where("text is not null").select(
        F.col("item_id").cast("bigint"), "text").orderBy("item_id", "text").collect()
    out = []
    for item_id, text in rows:
        terms, _ = term_hashes(pa.array([text]))
        if len(terms):
            out.append(Item(item_id, terms, term_hashes(pa.array([answer_part(text)]))[0]))
    return out


class Vocabulary(NamedTuple):
    """The items' terms, found by the top bits of their hash and then compared whole."""

    hashes: np.ndarray
    table: np.ndarray
    depth: int               # most terms that share a place

    @classmethod
    def of(cls, items: list[Item]) -> Vocabulary:
        hashes = np.unique(np.concatenate([i.terms for i in items]))
        table = np.full(1 << TABLE_BITS, -1, np.int32)
        # Terms that share a place follow each other.
        place, first, shared = np.unique(hashes >> np.uint64(64 - TABLE_BITS),
                                         return_index=True, return_counts=True)
        table[place.astype(np.int64)] = first
        return cls(hashes, table, int(shared.max()))

    def look_up(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term, or -1."""
        at = self.table[(terms >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        out = np.where(self.hashes[np.maximum(at, 0)] == terms, at, -1)
        for k in range(1, self.depth):
            open_ = np.flatnonzero((out < 0) & (at >= 0))
            next_ = np.minimum(at[open_] + k, len(self.hashes) - 1)
            hit = self.hashes[next_] == terms[open_]
            out[open_[hit]] = next_[hit]
        return out


def passage_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage number of every word of a batch, and each row's first passage."""
    counts = np.diff(first)
    heads = np.r_[0, np.cumsum(-(-counts // PASSAGE))]
    inside = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    return np.repeat(heads[:-1], counts) + inside // PASSAGE, heads


def passage_counts(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many passages of all documents each term of the vocabulary is, and of how many."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(sent.value.hashes)
        counts, passages = np.zeros(size, np.int64), 0
        for batch in batches:
            for low, high, data, offsets in grouped(batch.column("text")):
                data = LOWER[data]
                found = words(data, offsets, _APART)
                at = sent.value.look_up(word_hashes(data, found))
                passage, heads = passage_of(found.first)
                known = at >= 0
                pairs = np.sort(passage[known] * size + at[known])
                fresh = np.r_[True, pairs[1:] != pairs[:-1]][:len(pairs)]
                counts += np.bincount(pairs[fresh] % size, minlength=size)
                passages += int(heads[-1])
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, used], pa.int64()),
                                          pa.array(np.r_[passages, counts[used]], pa.int64())],
                                         ["term", "n"])

    rows = (id_and_text(docs).select("text").mapInArrow(count, "term bigint, n bigint")
            .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    table = dict(zip(rows["term"], rows["n"]))
    return (np.array([table.get(k, 0) for k in range(len(vocabulary.hashes))], np.int64),
            int(table.get(-1, 0)))


def inverse_frequency(counts: np.ndarray, passages: int) -> np.ndarray:
    """At least 1: a term in every passage still counts, as an item may be in all of them."""
    return np.log((passages + 1) / (counts + 1)) + 1


def latent_space(benchmark: DataFrame, vocabulary: Vocabulary, weight: np.ndarray,
                 seed: int = SEED) -> np.ndarray:
    """Right singular vectors of the items' TF-IDF matrix, by randomised subspace iteration.

    Each step multiplies a thin matrix by the transposed matrix times itself: every task does so
    for its items and Spark sums the rows. The driver only sees thin matrices (terms times rank).
    """
    size = len(vocabulary.hashes)
    thin = min(RANK + OVERSAMPLE, size)
    names = [f"c{k}" for k in range(thin)]
    session = benchmark.sparkSession

    def product(matrix: np.ndarray) -> np.ndarray:
        sent = session.sparkContext.broadcast((vocabulary, weight, matrix))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, scale, thin_matrix = sent.value
            total = np.zeros_like(thin_matrix)
            for batch in batches:
                terms, first = term_hashes(batch.column("text"))
                at = known.look_up(terms)
                for low, high in zip(first[:-1], first[1:]):
                    own = at[low:high][at[low:high] >= 0]
                    row = np.bincount(own, minlength=size) * scale
                    used = np.flatnonzero(row)
                    total[used] += np.outer(row[used], row[used] @ thin_matrix[used])
            used = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int64()), *(pa.array(total[used, k]) for k in range(thin))],
                ["term", *names])

        schema = ", ".join(["term bigint", *(f"{n} double" for n in names)])
        rows = (benchmark.select(F.coalesce("text", F.lit("")).alias("text"))
                .mapInArrow(run, schema).groupBy("term")
                .agg(*(F.sum(n).alias(n) for n in names)).toPandas())
        out = np.zeros_like(matrix)
        out[rows["term"].to_numpy(np.int64)] = rows[names].to_numpy(np.float64)
        return out

    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, thin)))[0]
    for _ in range(POWER_STEPS):
        basis = np.linalg.qr(product(basis))[0]
    values, turn = np.linalg.eigh(basis.T @ product(basis))
    best = np.argsort(-values)[:RANK]
    return basis @ turn[:, best[values[best] > 1e-9 * max(values.max(), 1e-30)]]


def bit_places(pattern: np.ndarray) -> dict[int, int]:
    """The places of each word of a pattern, one bit each."""
    places: dict[int, int] = {}
    for k, term in enumerate(pattern.tolist()):
        places[term] = places.get(term, 0) | 1 << k
    return places


def common_length(places: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence of a text and a pattern of ``size`` words."""
    row = full = (1 << size) - 1
    for term in text:
        if term in places:
            hit = row & places[term]
            if hit:
                row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def common_subsequence(pattern: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per word of the pattern."""
    return common_length(bit_places(pattern), len(pattern), text.tolist())


def piece_words(size: int) -> int:
    """Words in a piece for items of ``size`` words: a power of two, at least half the item.

    A window has ``PIECES`` pieces and begins at any of them, so half as many words again as the
    item has fit in some window, wherever they begin.
    """
    return 1 << max((size - 1).bit_length() - 1, 0)


class LengthClass(NamedTuple):
    """The items of one length class by their rare words."""

    piece: int               # words in a piece
    begin: np.ndarray        # per term of the vocabulary, and once behind the last: its postings
    item: np.ndarray         # per posting, places in ``Index.items``
    times: np.ndarray        # and how often the term is among the item's rare words
    need: np.ndarray         # per item: rare words that a leak holds

    @classmethod
    def of(cls, piece: int, items: list[Item], vocabulary: Vocabulary, counts: np.ndarray
           ) -> LengthClass:
        """Of an item's n words a leak holds at least k, so at least j of any n - k + j."""
        terms, owners, times = [], [], []
        need = np.zeros(len(items), np.int64)
        for place, item in enumerate(items):
            size = len(item.terms)
            if piece_words(size) != piece:
                continue
            least = next(k for k in range(size + 1) if k / size >= LCS_WITH_ANSWER)
            need[place] = min(least, int(np.ceil(RARE_SHARE * size)))
            at = vocabulary.look_up(item.terms)
            rare = at[np.lexsort((at, counts[at]))][:size - least + need[place]]
            term, many = np.unique(rare, return_counts=True)
            terms.append(term)
            times.append(many)
            owners.append(np.full(len(term), place))
        term, owner, many = (np.concatenate(x) for x in (terms, owners, times))
        order = np.argsort(term, kind="stable")
        begin = np.searchsorted(term[order], np.arange(len(vocabulary.hashes) + 1))
        return cls(piece, begin, owner[order], many[order], need)

    def candidates(self, at: np.ndarray, first: np.ndarray
                   ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Row, first word and item of the windows that hold enough of an item's rare words."""
        postings = np.r_[np.diff(self.begin), 0][at]           # none for -1
        pairs = np.r_[0, np.cumsum(postings)][first]
        for low, high in row_groups(pairs, PAIRS):
            if pairs[low] == pairs[high]:
                continue
            known = first[low] + np.flatnonzero(postings[first[low]:first[high]])
            # Rows lie PIECES - 1 empty pieces apart, so that no window reaches another row.
            heads = np.r_[0, np.cumsum(-(-np.diff(first[low:high + 1]) // self.piece)
                                       + PIECES - 1)]
            row = np.searchsorted(first[low:high + 1], known, side="right") - 1
            place = heads[row] + (known - first[low + row]) // self.piece
            size = len(self.begin) - 1
            held = np.unique(place * size + at[known])         # a term once per piece
            place, term = held // size, held % size
            many = self.begin[term + 1] - self.begin[term]
            posting = spread(self.begin[term], many)
            width = int(heads[-1]) + 1
            keys = self.item[posting] * width + np.repeat(place, many)
            order = np.argsort(keys)
            keys = keys[order]
            begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            total = np.r_[0, np.cumsum(np.add.reduceat(self.times[posting[order]], begins))]
            keys = keys[begins]
            item, place = keys // width, keys % width
            row = np.searchsorted(heads, place, side="right") - 1
            base = keys - place
            # No window over this piece can do with less than what lies around it.
            around = (total[np.searchsorted(keys, keys + PIECES)]
                      - total[np.searchsorted(keys, keys - PIECES + 1)])
            some = np.flatnonzero(around >= self.need[item])
            starts = np.unique(np.concatenate([
                base[some] + np.maximum(place[some] - k, heads[row[some]])
                for k in range(PIECES)]))
            sums = (total[np.searchsorted(keys, starts + PIECES)]
                    - total[np.searchsorted(keys, starts)])
            starts = starts[sums >= self.need[starts // width]]
            item, place = starts // width, starts % width
            row = np.searchsorted(heads, place, side="right") - 1
            yield low + row, first[low + row] + (place - heads[row]) * self.piece, item


class Index(NamedTuple):
    items: list[Item]
    vocabulary: Vocabulary
    fold: np.ndarray         # latent vector of one occurrence of each term
    latent: np.ndarray       # items in the latent space, of length one
    classes: list[LengthClass]

    def cosine(self, at: np.ndarray, item: int) -> float:
        whole = self.fold[at[at >= 0]].sum(axis=0)
        return float(whole @ self.latent[item] / max(np.linalg.norm(whole), 1e-9))

    def leaks(self, terms: np.ndarray, first: np.ndarray
              ) -> Iterator[tuple[int, int, float, float, bool]]:
        """Row, item place, cosine, covered share and answer of all leaks of a batch."""
        at = self.vocabulary.look_up(terms)
        best: dict[tuple[int, int], tuple[float, float, bool]] = {}
        patterns: dict[int, tuple[dict[int, int], dict[int, int]]] = {}
        for group in self.classes:
            for found in group.candidates(at, first):
                for row, begin, item in zip(*(x.tolist() for x in found)):
                    end = min(begin + PIECES * group.piece, int(first[row + 1]))
                    wanted, text = self.items[item], terms[begin:end].tolist()
                    if item not in patterns:
                        patterns[item] = bit_places(wanted.terms), bit_places(wanted.answer)
                    whole, part = patterns[item]
                    share = common_length(whole, len(wanted.terms), text) / len(wanted.terms)
                    if share < LCS_WITH_ANSWER:
                        continue
                    answer = bool(len(wanted.answer)) and (
                        common_length(part, len(wanted.answer), text)
                        >= ANSWER_SHARE * len(wanted.answer))
                    if share < LCS_ALONE and not answer:
                        continue
                    value = (share, self.cosine(at[begin:end], item), answer)
                    if (row, item) not in best or value > best[row, item]:
                        best[row, item] = value
        for (row, item), (share, cosine, answer) in sorted(best.items()):
            yield row, item, cosine, share, answer


def build_index(docs: DataFrame, benchmark: DataFrame) -> Index | None:
    """The index of one block of items; None if none of them has a word."""
    items = read_items(benchmark)
    if not items:
        return None
    vocabulary = Vocabulary.of(items)
    counts, passages = passage_counts(docs, vocabulary)
    weight = inverse_frequency(counts, passages)
    space = latent_space(benchmark, vocabulary, weight)
    fold = (space * weight[:, None]).astype(np.float32)
    latent = np.zeros((len(items), fold.shape[1]), np.float32)
    for k, item in enumerate(items):
        at = vocabulary.look_up(item.terms)
        latent[k] = fold[at[at >= 0]].sum(axis=0)
    latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-9)[:, None]
    classes = [LengthClass.of(piece, items, vocabulary, counts)
               for piece in sorted({piece_words(len(i.terms)) for i in items})]
    return Index(items, vocabulary, fold, latent, classes)


def indexes(docs: DataFrame, benchmark: DataFrame) -> list[Index]:
    """One index per block of at most about ``ITEM_BLOCK`` items."""
    blocks = -(-benchmark.count() // ITEM_BLOCK)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    built = (build_index(docs, benchmark if blocks < 2 else benchmark.where(part == k))
             for k in range(blocks))
    return [index for index in built if index is not None]


def _scan(column: pa.Array, index: Index) -> Iterator[tuple[int, int, float, float, bool]]:
    for low, _, data, offsets in grouped(column):
        data = LOWER[data]
        found = words(data, offsets, _APART)
        for row, item, cosine, share, answer in index.leaks(word_hashes(data, found),
                                                            found.first):
            yield low + row, index.items[item].item_id, cosine, share, answer


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, cosine, lcs_share, answer_found.

    The values are those of the window that covers most of the item. Null and empty texts and
    items have no words and match nothing; repeated rows are reported each; other columns are
    ignored; an empty table on either side gives no rows. Windows cover whole texts, and half as
    many words again as an item has fit in one wherever they begin.
    """
    session = docs.sparkSession
    texts = id_and_text(docs)
    schema = "doc_id bigint, item_id bigint, cosine double, lcs_share double, answer_found boolean"

    def search(index: Index) -> DataFrame:
        sent = session.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [*_scan(batch.column("text"), sent.value)]
                if rows:
                    at, items, cosines, shares, answers = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(at)), pa.array(items, pa.int64()),
                         pa.array(np.round(cosines, 6)), pa.array(np.round(shares, 6)),
                         pa.array(answers)],
                        ["doc_id", "item_id", "cosine", "lcs_share", "answer_found"])

        return texts.mapInArrow(run, schema)

    found = [search(index) for index in indexes(docs, benchmark)]
    if not found:
        return session.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    session, schema = docs.sparkSession, docs.schema
    for index in indexes(docs, benchmark):
        sent = session.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, *_ in _scan(batch.column("text"), sent.value)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, schema)
    return docs
