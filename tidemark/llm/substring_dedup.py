"""Repeated word windows found through difference-cover anchors.

Words are hashed at the positions of a difference cover: of any two positions, some common shift
below ``PERIOD`` takes both into the cover. So two equal windows of 20 words contain equal
anchors of eight words at the same distance from their starts, though only 4 of 13 positions are
hashed. Anchors that occur once cannot lie in a repeated window. Around the others windows are
hashed whole (128 bits), and of the equal ones all but the earliest are removed.

Copies of whole texts are settled by their digest: all but the one with the smallest id go.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import NULL_ID
from tidemark.llm.runs import later_rows, shared_keys
from tidemark.llm.textbytes import grouped, window_hashes, window_starts, word_hashes, words
from tidemark.session import materialise

WINDOW = 20
# A perfect difference cover; every residue modulo 13 is a difference of two.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def keyed(docs: DataFrame) -> DataFrame:
    """id (missing ones before all others), text, and a hash that tells texts of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)).alias("id"),
                       F.xxhash64(text).alias("th"), text.alias("text"))


def representatives(rows: DataFrame) -> DataFrame:
    """Per text the smallest id that has it; texts are told apart by their MD5 digest."""
    return (rows.select("id", "th", F.md5("text").alias("digest"))
            .groupBy("digest", "th").agg(F.min("id").alias("id")).select("id", "th"))


def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """hash, id, text hash and position of every anchor."""
    for batch in batches:
        ids, texts = batch.column("id").to_numpy(), batch.column("th").to_numpy()
        for low, high, data, offsets in grouped(batch.column("text")):
            found = words(data, offsets)
            starts = window_starts(found.first, ANCHOR)
            row = np.searchsorted(found.first, starts, side="right") - 1
            place = starts - found.first[row]
            chosen = _IN_COVER[place % PERIOD]
            hashes = window_hashes(word_hashes(data, found), starts[chosen], ANCHOR)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(ids[low:high][row[chosen]]),
                 pa.array(texts[low:high][row[chosen]]),
                 pa.array(place[chosen].astype(np.int32))], ["hash", "id", "th", "place"])


def candidate_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both hashes, id, text hash and position of windows that contain a shared anchor."""
    for batch in batches:
        ids, texts = batch.column("id").to_numpy(), batch.column("th").to_numpy()
        marks = batch.column("place")
        flat, marked = (marks.values.to_numpy(zero_copy_only=False),
                        marks.offsets.to_numpy(zero_copy_only=False))
        for low, high, data, offsets in grouped(batch.column("text")):
            found = words(data, offsets)
            per_row = np.diff(marked[low:high + 1])
            near = np.zeros(len(found.starts) + 1, np.int64)
            at = (np.repeat(found.first[:-1], per_row)
                  + flat[marked[low]:marked[high]])
            begin = np.maximum(at - PERIOD + 1, np.repeat(found.first[:-1], per_row))
            np.add.at(near, begin, 1)
            np.add.at(near, at + 1, -1)
            starts = window_starts(found.first, WINDOW)
            starts = starts[np.cumsum(near)[starts] > 0]
            row = np.searchsorted(found.first, starts, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(window_hashes(word_hashes(data, found, k), starts, WINDOW)
                            .view(np.int64)) for k in (0, 1)),
                 pa.array(ids[low:high][row]), pa.array(texts[low:high][row]),
                 pa.array((starts - found.first[row]).astype(np.int32))],
                ["hash", "hash2", "id", "th", "place"])


def remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts and kept text of each row, from the starts of its removed windows."""
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        texts = batch.column("text").to_pylist()
        places = batch.column("place").to_pylist()
        copies = batch.column("copy").to_pylist()
        for text, removed, copy in zip(texts, places, copies):
            parts = text.encode().split()
            size = len(parts)
            keep = np.ones(size, bool)
            if copy and size >= WINDOW:
                keep[:] = False
            elif removed:
                begins = np.unique(removed)            # equal rows report a window each
                change = np.zeros(size + 1, np.int64)
                change[begins] += 1
                change[begins + WINDOW] -= 1
                keep = np.cumsum(change[:-1]) == 0
            if not keep.all():
                parts = [parts[k] for k in np.flatnonzero(keep)]
            n_words.append(size)
            n_removed.append(size - len(parts))
            kept.append(b" ".join(parts).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.string())], ["id", "n_words", "n_removed", "kept"])


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in remaining(batches):
        kept = [sha256(t.encode()).hexdigest() for t in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(kept, pa.string())],
            ["id", "n_words", "n_removed", "kept_sha256"])


def removals(docs: DataFrame) -> DataFrame:
    """id, th, text, starts of the windows to remove (``place``), and whether the row is a copy.

    Two streams over sorted rows replace grouping: neither a common anchor nor a common window
    is ever gathered in memory. The texts are shuffled once, by id, and that shuffle serves the
    anchors, the candidate windows and the result. Copies take no part before the result, so
    they mark nothing in the text they are copies of.
    """
    rows = keyed(docs)
    reps = materialise(representatives(rows))
    firsts = rows.join(reps, ["id", "th"])
    marks = (firsts.select("id", "th", "text")
             .mapInArrow(anchors, "hash bigint, id bigint, th bigint, place int")
             .repartition("hash").sortWithinPartitions("hash")
             .mapInArrow(lambda it: shared_keys(it, ["hash"]),
                         "hash bigint, id bigint, th bigint, place int")
             .groupBy("id", "th").agg(F.collect_list("place").alias("place")))
    windows = (rows.join(marks, ["id", "th"])
               .select("id", "th", "text", "place")
               .mapInArrow(candidate_windows,
                           "hash bigint, hash2 bigint, id bigint, th bigint, place int"))
    later = (windows.repartition("hash", "hash2")
             .sortWithinPartitions("hash", "hash2", "id", "th", "place")
             .mapInArrow(lambda it: later_rows(it, ["hash", "hash2"], ["id", "th", "place"]),
                         "hash bigint, hash2 bigint, id bigint, th bigint, place int")
             .groupBy("id", "th").agg(F.collect_list("place").alias("place")))
    flags = reps.withColumn("first", F.lit(True)).join(later, ["id", "th"], "left")
    twin = Window.partitionBy("id", "th").orderBy("id")
    return (rows.join(flags, ["id", "th"], "left")
            .withColumn("copy", F.col("first").isNull() | (F.row_number().over(twin) > 1))
            .select("id", "th", "text", "place", "copy"))


def _own_id(rows: DataFrame, *rest: str) -> DataFrame:
    return rows.select(F.nullif("id", F.lit(NULL_ID)).alias("doc_id"), *rest)


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and the kept text as ``kept``.

    A word goes if a window of 20 words over it also starts earlier: in a document with a
    smaller id, or earlier in the same one. Windows are judged on the input. Rows with the same
    id are ordered by a hash of their texts, equal rows count as copies after the first, and a
    missing id comes before all others. Texts with fewer than 20 words lose nothing; null and
    empty texts have no words; other columns are ignored; an empty table gives no rows.
    """
    out = removals(docs).mapInArrow(
        remaining, "id bigint, n_words bigint, n_removed bigint, kept string")
    return _own_id(out, "n_words", "n_removed", "kept")


def dedup_digest(docs: DataFrame) -> DataFrame:
    """``dedup`` with the SHA-256 of the kept text in place of the text."""
    out = removals(docs).mapInArrow(
        digests, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
    return _own_id(out, "n_words", "n_removed", "kept_sha256")


ORACLE_SQL = r"""
with base as (
    select row_number() over (order by doc_id) as rid, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
places as (
    select rid, w, unnest(generate_series(1, len(w) - 19)) as i from base where len(w) >= 20),
found as (
    select rid, i, row_number() over (
               partition by array_to_string(w[i : i + 19], ' ') order by rid, i) as n
    from places),
gone as (
    select distinct rid, i + k as i
    from found, (select unnest(generate_series(0, 19)) as k) where n > 1),
lost as (select rid, count(*) as n, list(i) as places from gone group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(l.n, 0)::bigint as n_removed,
       sha256(array_to_string(case when l.n is null then w else
           list_transform(list_filter(list_zip(w, generate_series(1, len(w))),
                                      lambda z: not list_contains(l.places, z[2])),
                          lambda z: z[1]) end, ' ')) as kept_sha256
from base left join lost l using (rid)
"""
