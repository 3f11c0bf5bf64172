"""Exact byte-pair token counts by merging on a heap over a linked list of symbols.

A piece of text starts as a list of byte symbols. The adjacent pair with the lowest merge rank,
leftmost among equals, is popped and merged until none is left; each merge removes one symbol,
so the count is the number of bytes less the number of merges. No token ids are put out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

#: Pieces whose counts a worker keeps; beyond it the memory is emptied and refilled.
MEMORY_PIECES = 400_000

# The splitting pattern of the byte-level vocabulary, with its white space
# (Unicode White_Space) spelled out, since Python's \s has four control characters more.
_SPACES = r"\t-\r \x85\xa0  -     　"
_UNICODE = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACES}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")
# The same for texts below U+0100, with letters, numbers and spaces spelled out.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_LATIN = re.compile(
    rf" ?[{_L}]+| ?[{_N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_ABOVE_LATIN = re.compile("[^\x00-\xff]")


def _printable_bytes() -> dict[str, int]:
    """The characters by which byte-level vocabularies write the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return ({chr(b): b for b in plain}
            | {chr(256 + k): b for k, b in enumerate(others)})


class PairMerger:
    """Counts tokens of pieces and of whole texts with one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.byte_symbol = [0] * 256
        for letter, byte in _printable_bytes().items():
            self.byte_symbol[byte] = vocabulary[letter]
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for pair in merges:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocabulary[left] << 32 | vocabulary[right]] = len(self.merged)
            self.merged.append(vocabulary[left + right])
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len)[::-1]))
                                  ) if specials else None
        self.memory = _Memory(self.count_piece)

    def count_piece(self, piece: str) -> int:
        data = piece.encode("utf-8", "replace")
        size = len(data)
        if size < 2:
            return size
        symbol = [self.byte_symbol[b] for b in data]
        rank, merged = self.rank.get, self.merged
        after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
        heap = [r << 32 | at for at in range(size - 1)
                if (r := rank(symbol[at] << 32 | symbol[at + 1])) is not None]
        heapify(heap)
        merges = 0
        while heap:
            item = heappop(heap)
            lowest, at = item >> 32, item & 0xFFFFFFFF
            right = after[at]
            if (symbol[at] < 0 or right >= size
                    or rank(symbol[at] << 32 | symbol[right]) != lowest):
                continue                       # the pair has been merged away meanwhile
            symbol[at], symbol[right] = merged[lowest], -1
            beyond, left = after[right], before[at]
            after[at] = beyond
            merges += 1
            if beyond < size:
                before[beyond] = at
                if (r := rank(symbol[at] << 32 | symbol[beyond])) is not None:
                    heappush(heap, r << 32 | at)
            if left >= 0 and (r := rank(symbol[left] << 32 | symbol[at])) is not None:
                heappush(heap, r << 32 | left)
        return size - merges

    def count_text(self, text: str) -> int:
        if self.special is None:
            return self._count_plain(text)
        specials = self.special.findall(text)
        if not specials:
            return self._count_plain(text)
        return len(specials) + sum(map(self._count_plain, self.special.split(text)))

    def _count_plain(self, text: str) -> int:
        pattern = _UNICODE if _ABOVE_LATIN.search(text) else _LATIN
        return sum(map(self.memory.__getitem__, pattern.findall(text)))


class _Memory(dict):
    """Counts of pieces met before; bounded, and short pieces only."""

    def __init__(self, count) -> None:
        self.count = count

    def __missing__(self, piece: str) -> int:
        tokens = self.count(piece)
        if len(piece) <= 64:
            if len(self) >= MEMORY_PIECES:
                self.clear()
            self[piece] = tokens
        return tokens


@cache
def merger(path: str) -> PairMerger:
    return PairMerger(path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    ``vocabulary`` is the path of a byte-level vocabulary file, there on every machine. A null
    text counts as empty and has no tokens; repeated rows are counted each; other columns are
    ignored; an empty table gives no rows. Texts of any length are counted whole; one piece
    (a run without spaces) takes memory in proportion to its length and ``n log n`` time.
    """
    path = vocabulary or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = merger(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array([counter.count_text(t) for t in texts], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    counted = id_and_text(docs).mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
