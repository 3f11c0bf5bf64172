"""Repeated byte strings found by induced suffix sorting in shards that may exceed memory.

Every 100-byte window is named by its anchor: of the 32-byte grams inside it, the one with the
smallest hash. Equal windows have equal anchors at equal places, so anchors say which windows
must be compared, and an anchor that occurs once rules out all its windows. The windows of the
others are sent, with their text, to the shard of their anchor. A shard is one long string; its
suffixes are sorted by induction, and neighbours with a common prefix of 100 bytes are equal
windows, of which all but the earliest are removed.

Sorting works through queues, one per leading symbol, that are drained in symbol order: a suffix
taken from a queue hands the suffix before it on to its own queue. Queues, text and types live in
files once they outgrow ``MEMORY_BYTES``.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.runs import shared_keys
from tidemark.llm.substring_dedup import _own_id, keyed, representatives
from tidemark.llm.textbytes import BYTE_VALUES, grouped, mix, powers, running, span_hash, spread
from tidemark.session import materialise

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1                 # grams in a window
#: A shard takes anchors until it has so many bytes of distinct strings; sorting them takes some
#: 130 bytes of memory per byte.
SHARD_BYTES = 1 << 20
MEMORY_BYTES = 64 << 20


# ---------------------------------------------------------------------------------------------
# Anchors
# ---------------------------------------------------------------------------------------------
def window_anchors(data: np.ndarray, offsets: np.ndarray
                   ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of every 100-byte window, its anchor's position, and the hashes of all grams.

    Among equal hashes the leftmost gram is the anchor, so that it depends on the window only.
    """
    size = len(data)
    if size < LENGTH:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(0, np.uint64)
    sums = running(BYTE_VALUES[0][data])
    up = size - GRAM + 1
    grams = mix((sums[GRAM:] - sums[:up]) * powers(size + 1)[1][:up])
    # The position goes below half of the hash: one minimum finds the smallest gram and its place.
    packed = grams >> np.uint64(32) << np.uint64(32) | np.arange(up, dtype=np.uint64)
    low, reach = packed, 1
    while reach * 2 <= SPAN:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < SPAN:
        low = np.minimum(low[:len(low) - (SPAN - reach)], low[SPAN - reach:])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    counts = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    starts = spread(offsets[:-1], counts)
    return starts, at[starts], grams


def anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hash, id, text hash and position of every anchor of every text."""
    for batch in batches:
        ids, hashes_of = batch.column("id").to_numpy(), batch.column("th").to_numpy()
        for low, high, data, offsets in grouped(batch.column("text")):
            starts, at, grams = window_anchors(data, offsets)
            used = at[np.flatnonzero(np.diff(at, prepend=-1))]
            row = np.searchsorted(offsets, used, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[used].view(np.int64)), pa.array(ids[low:high][row]),
                 pa.array(hashes_of[low:high][row]),
                 pa.array((used - offsets[row]).astype(np.int32))],
                ["hash", "id", "th", "place"])


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes under all windows of each shared anchor, with the place of the first window."""
    for batch in batches:
        ids, hashes_of = batch.column("id").to_numpy(), batch.column("th").to_numpy()
        marks = batch.column("place")
        flat = marks.values.to_numpy(zero_copy_only=False)
        marked = marks.offsets.to_numpy(zero_copy_only=False)
        for low, high, data, offsets in grouped(batch.column("text")):
            starts, at, grams = window_anchors(data, offsets)
            if not len(starts):
                continue
            heads = np.flatnonzero(np.r_[True, np.diff(at) != 0])
            anchor, first = at[heads], starts[heads]
            count = np.diff(np.r_[heads, len(at)])
            shared = np.zeros(len(data), bool)
            shared[np.repeat(offsets[:-1], np.diff(marked[low:high + 1]))
                   + flat[marked[low]:marked[high]]] = True
            use = shared[anchor]
            anchor, first, count = anchor[use], first[use], count[use]
            row = np.searchsorted(offsets, first, side="right") - 1
            sizes = count + LENGTH - 1
            body = data[spread(first, sizes)].tobytes()
            edges = np.r_[0, np.cumsum(sizes)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[anchor].view(np.int64)), pa.array(ids[low:high][row]),
                 pa.array(hashes_of[low:high][row]),
                 pa.array((first - offsets[row]).astype(np.int32)),
                 pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [
                     None, pa.py_buffer(edges), pa.py_buffer(body)])],
                ["hash", "id", "th", "start", "body"])


# ---------------------------------------------------------------------------------------------
# Induced sorting
# ---------------------------------------------------------------------------------------------
class Store:
    """Arrays in memory while they are small in sum, in unnamed files after that."""

    def __init__(self, limit: int = MEMORY_BYTES) -> None:
        self.left = limit

    def keep(self, values: np.ndarray) -> np.ndarray:
        self.left -= values.nbytes
        if self.left >= 0 or not values.nbytes:
            return values
        with tempfile.TemporaryFile() as file:         # gone with the last map of it
            values.tofile(file)
            file.flush()
            return np.memmap(file, values.dtype, "r", shape=values.shape)


class Queues:
    """One first-in first-out queue of suffixes per leading symbol, drained in symbol order."""

    def __init__(self, store: Store, symbols: int) -> None:
        self.store = store
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def put(self, suffixes: np.ndarray, symbols: np.ndarray) -> None:
        if not len(suffixes):
            return
        order = np.argsort(symbols, kind="stable")
        suffixes, symbols = self.store.keep(suffixes[order]), symbols[order]
        heads = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        for symbol, low, high in zip(symbols[heads].tolist(), heads, [*heads[1:], len(symbols)]):
            self.waiting[symbol].append(suffixes[low:high])

    def take(self, symbol: int) -> np.ndarray:
        parts, self.waiting[symbol] = self.waiting[symbol], []
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last one counts as such."""
    out = np.ones(len(text), bool)
    if len(text) > 1:
        equal = text[:-1] == text[1:]
        settled = np.where(equal, len(text), np.arange(len(text) - 1))
        settled = np.minimum.accumulate(settled[::-1])[::-1]
        out[:-1] = (text[:-1] < text[1:])[np.minimum(settled, len(text) - 2)]
    return out


def induce(text: np.ndarray, rising: np.ndarray, seeds: np.ndarray, symbols: int,
           store: Store) -> Iterator[np.ndarray]:
    """All suffixes but the last, in order and in parts, from their sorted seeds.

    Seeds are the suffixes that rise after a fall. First, falling suffixes follow from what is
    in front of taken ones, in rising symbol order; then rising ones, in falling order.
    """
    def before(suffixes: np.ndarray, want_rising: bool) -> tuple[np.ndarray, np.ndarray]:
        ahead = suffixes[suffixes > 0] - 1
        ahead = ahead[rising[ahead] == want_rising]
        return ahead, text[ahead]

    def drain(queues: Queues, symbol: int, want_rising: bool) -> np.ndarray:
        now, parts = queues.take(symbol), []
        while len(now):
            parts.append(now)
            ahead, leading = before(now, want_rising)
            own = leading == symbol
            queues.put(ahead[~own], leading[~own])
            now = ahead[own]
        return np.concatenate(parts) if parts else now

    falling_queues, rising_queues = Queues(store, symbols), Queues(store, symbols)
    seed_queues = Queues(store, symbols)
    seed_queues.put(seeds, text[seeds])
    falling = []
    for symbol in range(symbols):
        falling.append(store.keep(drain(falling_queues, symbol, False)))
        falling_queues.put(*before(seed_queues.take(symbol), False))
    rising_parts = []
    for symbol in reversed(range(symbols)):
        rising_parts.append(store.keep(drain(rising_queues, symbol, True)))
        rising_queues.put(*before(falling[symbol][::-1], True))
    for symbol in range(symbols):
        yield falling[symbol]
        yield rising_parts[symbols - 1 - symbol][::-1]


def ordered_seeds(text: np.ndarray, rising: np.ndarray, symbols: int, depth: int,
                  store: Store) -> np.ndarray:
    """Seeds in order of their suffixes, as far as ``depth`` symbols tell them apart.

    A first induction from unordered seeds orders the pieces between seeds. Pieces get ranks,
    and ranks of ever more pieces in a row are joined until they span the depth or differ.
    """
    is_seed = rising.copy()
    is_seed[0] = False
    is_seed[1:] &= ~rising[:-1]
    seeds = np.flatnonzero(is_seed).astype(np.int32)
    if len(seeds) < 2:
        return seeds
    by_piece = np.concatenate([[len(text) - 1], *(
        part[is_seed[part]] for part in induce(text, rising, seeds, symbols, store))])
    slot = np.zeros(len(text), np.int32)
    slot[seeds] = np.arange(len(seeds), dtype=np.int32)
    order = slot[by_piece]
    ends = np.minimum(np.r_[seeds[1:], len(text) - 1] + 1, len(text))
    values = mix(text.astype(np.uint64) + np.uint64(1))
    pieces = span_hash(running(values), seeds, ends)[order]
    fresh = np.r_[True, pieces[1:] != pieces[:-1]]
    rank = np.empty(len(seeds), np.int64)
    rank[order] = np.cumsum(fresh) - 1
    step = 1
    while step < len(seeds):
        repeated = np.bincount(rank)[rank] > 1
        reach = seeds[np.minimum(np.arange(len(seeds)) + step, len(seeds) - 1)] - seeds
        if not (repeated & (reach < depth)).any():
            break
        after = np.zeros(len(seeds), np.int64)
        after[:-step] = rank[step:] + 1
        _, rank = np.unique(rank * (len(seeds) + 1) + after, return_inverse=True)
        step *= 2
    return seeds[np.argsort(rank, kind="stable")]


def sorted_suffixes(text: np.ndarray, symbols: int, depth: int = LENGTH,
                    store: Store | None = None) -> Iterator[np.ndarray]:
    """Suffixes in parts, ordered as far as ``depth`` symbols tell; the last one is left out.

    ``text`` ends with the symbol 0, which occurs nowhere else.
    """
    store = store or Store()
    rising = suffix_types(text)
    yield from induce(text, rising, ordered_seeds(text, rising, symbols, depth, store), symbols,
                      store)


# ---------------------------------------------------------------------------------------------
# Shards
# ---------------------------------------------------------------------------------------------
def equal_windows(bodies: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows in suffix order: string and offset of each, and whether it equals the one before.

    The common prefix of neighbours is compared up to 100 bytes, by two hashes of 64 bits.
    """
    sizes = np.array([len(b) for b in bodies])
    base = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(bodies) + 1, np.uint16)
    text[:-1] = np.frombuffer(b"\0".join([*bodies, b""]), np.uint8)
    text[:-1] += 2
    text[base + sizes] = 1                                 # between strings
    full = np.zeros(len(text), bool)
    full[spread(base, np.maximum(sizes - LENGTH + 1, 0))] = True
    sums = [running(values[text.astype(np.uint8)]) for values in BYTE_VALUES]
    last = None
    for part in sorted_suffixes(text, 258):
        at = part[full[part]].astype(np.int64)
        if not len(at):
            continue
        prefix = [span_hash(s, at, at + LENGTH) for s in sums]
        same = np.zeros(len(at), bool)
        same[1:] = (prefix[0][1:] == prefix[0][:-1]) & (prefix[1][1:] == prefix[1][:-1])
        same[0] = last is not None and all(p[0] == v for p, v in zip(prefix, last))
        last = [p[-1] for p in prefix]
        owner = np.searchsorted(base, at, side="right") - 1
        yield owner, at - base[owner], same


def shard_removals(bodies: list[bytes], places: tuple[np.ndarray, np.ndarray, np.ndarray]
                   ) -> pa.RecordBatch:
    """Windows of one shard that are not the earliest of their kind.

    ``places`` has id, th and start of the one row that stands for each string. Windows come
    in suffix order, part by part; of the kind that a part ends in, the earliest window so far
    is carried on to the next. What is removed is noted by a flag per byte of the shard.
    """
    ids, ths, starts = places
    sizes = np.array([len(b) for b in bodies])
    base = np.cumsum(sizes) - sizes
    gone = np.zeros(int(sizes.sum()), bool)
    carried: np.ndarray | None = None          # string and offset
    for strings, offsets, same in equal_windows(bodies):
        kind = np.cumsum(~same)
        if carried is not None and same[0]:
            strings, offsets = np.r_[carried[0], strings], np.r_[carried[1], offsets]
            kind = np.r_[0, kind]
        where = ids[strings], ths[strings], starts[strings] + offsets
        order = np.lexsort((where[2], where[1], where[0], kind))
        begins = np.r_[True, kind[order][1:] != kind[order][:-1]]
        head = order[np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))]
        differs = np.zeros(len(order), bool)
        for values in where:
            differs |= values[order] != values[head]
        later = order[differs]
        gone[base[strings[later]] + offsets[later]] = True
        carried = np.array([strings[head[-1]], offsets[head[-1]]])
    at = np.flatnonzero(gone)
    owner = np.searchsorted(base, at, side="right") - 1
    # Consecutive windows of a string become one run.
    breaks = np.flatnonzero((at[1:] > at[:-1] + 1) | (owner[1:] != owner[:-1])) + 1
    first = np.r_[0, breaks] if len(at) else breaks
    last = np.r_[breaks, len(at)][:len(first)] - 1
    of = owner[first]
    return _runs(ids[of], ths[of], starts[of] + at[first] - base[of],
                 starts[of] + at[last] - base[of] + LENGTH)


def _runs(ids, ths, low, high) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(ths, pa.int64()),
         pa.array(np.asarray(low, np.int32)), pa.array(np.asarray(high, np.int32))],
        ["id", "th", "low", "high"])


def shards(batches: Iterator[pa.RecordBatch], shard_bytes: int = SHARD_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """Removed byte runs, shard after shard.

    Rows come sorted by anchor, which no cut divides, then string and place. The first row of a
    string stands for it. All windows of its other rows are later copies, so those rows are
    answered at once and never held, however many there are.
    """
    bodies: list[bytes] = []
    places: list[tuple[int, int, int]] = []
    held, key = 0, None

    def done() -> pa.RecordBatch:
        ids, ths, starts = (np.array(c, np.int64) for c in zip(*places))
        return shard_removals(bodies, (ids, ths, starts))

    last = None
    for batch in batches:
        copies: list[tuple[int, int, int, int]] = []
        for anchor, row_id, th, start, body in zip(*(
                batch.column(c).to_pylist() for c in ("hash", "id", "th", "start", "body"))):
            if anchor != key:
                key, last = anchor, None
                if held >= shard_bytes:
                    yield done()
                    bodies, places, held = [], [], 0
            if body == last:
                if (row_id, th, start) != places[-1]:      # a repeated row is no other place
                    copies.append((row_id, th, start, start + len(body)))
            else:
                last = body
                bodies.append(body)
                places.append((row_id, th, start))
                held += len(body)
        if copies:
            yield _runs(*zip(*copies))
    if bodies:
        yield done()


# ---------------------------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------------------------
def joined_runs(lows: list[int], highs: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(zip(lows, highs)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte counts and kept bytes of each row, from its removed runs."""
    for batch in batches:
        rows = []
        for text, runs, copy in zip(*(batch.column(c).to_pylist()
                                      for c in ("text", "runs", "copy"))):
            body = text.encode()
            if copy:
                gone = [(0, len(body))] if len(body) >= LENGTH else []
            else:
                gone = joined_runs([r["low"] for r in runs or ()], [r["high"] for r in runs or ()])
            at, kept = 0, []
            for low, high in gone:
                kept.append(body[at:low])
                at = high
            kept.append(body[at:])
            rows.append((len(body), sum(h - l for l, h in gone), len(gone), b"".join(kept)))
        size, removed, spans, kept = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in remaining(batches):
        kept = [sha256(b).hexdigest() for b in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(kept, pa.string())],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removals(docs: DataFrame) -> DataFrame:
    """id, th, text, removed byte runs, and whether the row is a copy of an earlier one.

    The texts are shuffled once, by id, for the anchors, the contexts and the result. Copies
    take no part before the result.
    """
    rows = keyed(docs)
    reps = materialise(representatives(rows))
    firsts = rows.join(reps, ["id", "th"])
    marks = (firsts.select("id", "th", "text")
             .mapInArrow(anchor_hashes, "hash bigint, id bigint, th bigint, place int")
             .repartition("hash").sortWithinPartitions("hash")
             .mapInArrow(lambda it: shared_keys(it, ["hash"]),
                         "hash bigint, id bigint, th bigint, place int")
             .groupBy("id", "th").agg(F.collect_list("place").alias("place")))
    later = (rows.join(marks, ["id", "th"])
             .select("id", "th", "text", "place")
             .mapInArrow(contexts, "hash bigint, id bigint, th bigint, start int, body binary")
             .repartition("hash").sortWithinPartitions("hash", "body", "id", "th", "start")
             .mapInArrow(lambda it: shards(it), "id bigint, th bigint, low int, high int")
             .groupBy("id", "th").agg(F.collect_list(F.struct("low", "high")).alias("runs")))
    flags = reps.withColumn("first", F.lit(True)).join(later, ["id", "th"], "left")
    twin = Window.partitionBy("id", "th").orderBy("id")
    return (rows.join(flags, ["id", "th"], "left")
            .withColumn("copy", F.col("first").isNull() | (F.row_number().over(twin) > 1))
            .select("id", "th", "text", "runs", "copy"))


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans and the kept bytes as ``kept``.

    A byte goes if a string of 100 bytes over it also starts earlier: in a document with a
    smaller id, or earlier in the same one; strings may overlap and are judged on the input.
    Texts are taken as UTF-8, so what is kept may cut a character. Rows with the same id are
    ordered by a hash of their texts, equal rows count as copies after the first, and a missing
    id comes before all others. Null and empty texts have no bytes; other columns are ignored;
    an empty table gives no rows.
    """
    out = removals(docs).mapInArrow(
        remaining, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return _own_id(out, "n_bytes", "n_removed", "n_spans", "kept")


def dedup_digest(docs: DataFrame) -> DataFrame:
    """``dedup`` with the SHA-256 of the kept bytes in place of the bytes."""
    out = removals(docs).mapInArrow(
        digests, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint,"
                 " kept_sha256 string")
    return _own_id(out, "n_bytes", "n_removed", "n_spans", "kept_sha256")
