"""Exact encoding and decoding with a merge-type piece vocabulary, by backtracking.

The library joins the best-scored adjacent pair, again and again. The same pieces come out by
reading from left to right: take the longest piece that starts here, as an Aho-Corasick automaton
finds it; keep it if joining the characters of the last piece and this one gives back just these
two; otherwise try the next shorter piece, and go back one piece when none is left. A bit per
position remembers where nothing fits, so no position is given up twice.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Iterator
from functools import cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_and_text

#: Chunks of text and pairs of pieces a worker remembers; emptied and refilled beyond that.
MEMORY_CHUNKS = 400_000
MEMORY_PAIRS = 1_000_000
LONGEST_REMEMBERED = 64
#: How the vocabulary writes a space.
SPACE = "▁"


class _Shorter(dict):
    """The longest piece or single character that a piece starts with, itself excepted."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces = pieces

    def __missing__(self, piece: str) -> str | None:
        prefixes = (piece[:size] for size in range(len(piece) - 1, 0, -1))
        found = next((p for p in prefixes if p in self.pieces or len(p) == 1), None)
        self[piece] = found
        return found


class PieceCodec:
    """Encodes and decodes with the vocabulary of one model file."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        rules, trained = model.normalizer_spec, model.trainer_spec
        if (trained.model_type != trained.BPE or not trained.byte_fallback
                or rules.precompiled_charsmap or not rules.add_dummy_prefix
                or rules.remove_extra_whitespaces or trained.treat_whitespace_as_suffix
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
            raise ValueError("only merge-type models with byte pieces, a leading space and texts "
                             "taken as they are can be read")
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id = [0] * 256
        self.surface: list[str | int] = []     # what a piece stands for; a byte as its number
        for number, piece in enumerate(model.pieces):
            text = piece.piece
            if piece.type == kinds.BYTE:
                self.byte_id[int(text[3:5], 16)] = number
                self.surface.append(int(text[3:5], 16))
            elif piece.type == kinds.NORMAL:
                self.id_of[text], self.score[text] = number, piece.score
                self.surface.append(text)
            else:
                self.surface.append(trained.unk_surface if piece.type == kinds.UNKNOWN else "")
            if piece.type == kinds.CONTROL and text == trained.eos_piece:
                self.end = number
        self.automaton = ahocorasick.Automaton()
        for text in self.score:
            self.automaton.add_word(text, len(text))
        self.automaton.make_automaton()
        self.fits_memory: dict[tuple[str, str], bool] = {}
        self.shorter_memory = _Shorter(self.score)
        self.chunk_memory: dict[str, tuple[int, str, str]] = {}
        self.chunks = self._chunk_pattern()

    def _chunk_pattern(self) -> re.Pattern:
        """Where texts may be cut: no piece goes over such a place, so no merge ever does."""
        def none_has(first: str, second: str) -> bool:
            return not any(re.search(first + second, text) for text in self.score)

        if not none_has(f"[^{SPACE}]", SPACE) or not none_has("", "\n"):
            return re.compile(r"(?s).+")
        sign, letter, ends = r"!-/:-@\[-`{-~", "A-Za-z\xc0-\u024f", f"{SPACE}\n"
        rest = f"[^{ends}]+"
        if none_has(f"[{sign}]", f"[{letter}]") and none_has(f"[{letter}]", f"[{sign}]"):
            # A word up to a sign, or signs up to a word; anything mixed stays whole.
            rest = f"[{letter}]++(?![^{sign}{ends}])|[{sign}]++(?![^{letter}{ends}])|{rest}"
        return re.compile(f"{SPACE}*(?:{rest})|{SPACE}+|\n+")

    # Encoding

    def merged(self, text: str) -> list[str]:
        """Pieces by joining the best-scored pair, leftmost first, until no pair is a piece."""
        symbols: list[str | None] = list(text)
        size = len(symbols)
        after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
        score = self.score.get
        heap = [(-s, at) for at in range(size - 1)
                if (s := score(text[at:at + 2])) is not None]
        heapify(heap)
        lengths = [1] * size
        while heap:
            worse, at = heappop(heap)
            right = after[at]
            if symbols[at] is None or right >= size:
                continue
            both = symbols[at] + symbols[right]
            if (s := score(both)) is None or -s != worse:
                continue                       # one of the two has been joined meanwhile
            symbols[at], symbols[right] = both, None
            lengths[at] += lengths[right]
            beyond, left = after[right], before[at]
            after[at] = beyond
            if beyond < size:
                before[beyond] = at
                if (s := score(both + symbols[beyond])) is not None:
                    heappush(heap, (-s, at))
            if left >= 0 and (s := score(symbols[left] + both)) is not None:
                heappush(heap, (-s, left))
        return [s for s in symbols if s is not None]

    def fits(self, last: str, piece: str) -> bool:
        """Whether joining their characters anew ends in just these two; remembered."""
        if len(self.fits_memory) >= MEMORY_PAIRS:
            self.fits_memory.clear()
        both = [last, piece] if last else [piece]
        known = self.fits_memory[last, piece] = self.merged(last + piece) == both
        return known

    def split(self, text: str) -> list[str]:
        """Pieces of a text by backtracking; characters without a piece stand for themselves."""
        size = len(text)
        longest = [1] * size
        for end, length in self.automaton.iter(text):
            start = end - length + 1
            if length > longest[start]:
                longest[start] = length
        open_places = bytearray(b"\xff") * (size // 8 + 1)
        pieces: list[str] = []
        at, piece, last = 0, text[:longest[0]] if size else None, ""
        remembered, shorter = self.fits_memory.get, self.shorter_memory
        while at < size:
            while piece is not None:
                end = at + len(piece)
                if open_places[end >> 3] >> (end & 7) & 1:
                    if (fits := remembered((last, piece))) is None:
                        fits = self.fits(last, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece is not None:
                pieces.append(piece)
                at, last = end, piece
                piece = text[at:at + longest[at]] if at < size else None
            else:
                open_places[at >> 3] &= ~(1 << (at & 7))
                piece = pieces.pop()
                last = pieces[-1] if pieces else ""
                at -= len(piece)
        return pieces

    def ids_of(self, piece: str) -> list[int]:
        number = self.id_of.get(piece)
        return [self.byte_id[b] for b in piece.encode()] if number is None else [number]

    def _chunk(self, chunk: str) -> tuple[int, str, str]:
        """Number of ids, ids as text, and what they decode to, of a part of a text."""
        known = self.chunk_memory.get(chunk)
        if known is None:
            ids = [i for piece in self.split(chunk) for i in self.ids_of(piece)]
            known = len(ids), " ".join(map(str, ids)), self._surfaces(ids)
            if len(chunk) <= LONGEST_REMEMBERED:
                if len(self.chunk_memory) >= MEMORY_CHUNKS:
                    self.chunk_memory.clear()
                self.chunk_memory[chunk] = known
        return known

    def _prepared(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def encode(self, text: str) -> list[int]:
        """All ids of a text with the end id."""
        ids = [int(i) for chunk in self.chunks.findall(self._prepared(text))
               for i in self._chunk(chunk)[1].split(" ")]
        return [*ids, self.end]

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, their sha256, and the sha256 of the text they decode to."""
        parts = [*map(self._chunk, self.chunks.findall(self._prepared(text)))]
        ids = " ".join([*(p[1] for p in parts), str(self.end)])
        decoded = "".join([p[2] for p in parts])[1:]     # less the leading space
        return (sum(p[0] for p in parts) + 1, sha256(ids.encode()).hexdigest(),
                sha256(decoded.encode()).hexdigest())

    # Decoding

    def _surfaces(self, ids: Iterable[int]) -> str:
        return "".join(self._parts(ids)).replace(SPACE, " ")

    def _parts(self, ids: Iterable[int]) -> Iterator[str]:
        waiting = bytearray()
        for number in ids:
            surface = self.surface[number]
            if isinstance(surface, int):
                waiting.append(surface)
                continue
            if waiting:
                yield waiting.decode("utf-8", "tidemark-byte-by-byte")
                waiting.clear()
            yield surface
        if waiting:
            yield waiting.decode("utf-8", "tidemark-byte-by-byte")

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids: bytes that are no character become U+FFFD each, control ids
        nothing, and the space that every text starts with goes away again."""
        parts = [part for part in self._parts(ids) if part]
        if parts and parts[0].startswith(SPACE):
            parts[0] = parts[0][1:]
        return "".join(parts).replace(SPACE, " ")


codecs.register_error("tidemark-byte-by-byte", lambda e: ("�", e.start + 1))


@cache
def codec(path: str) -> PieceCodec:
    return PieceCodec(path)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ``ids``, all ids of the whole text with the end id, one row per document.

    ``model`` is the path of a model file, there on every machine. A null text counts as empty
    and has the end id only; repeated rows come out each, null ids of documents stay null; other
    columns are ignored; an empty table gives no rows. One stretch without spaces is handled as
    a whole, in memory in proportion to its length.
    """
    path = model or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = [own.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_and_text(docs).mapInArrow(work, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id and ``text`` of rows with doc_id and ids; null ids count as none, a null among them
    is left out, and ids outside the vocabulary raise IndexError. Other columns are ignored."""
    path = model or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = [own.decode(i for i in ids or () if i is not None)
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                          F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(work, "doc_id bigint, text string")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256 and decoded_sha256.

    The first hash is of the decimal ids joined by one space, the second of the text that they
    decode to. Awkward rows are treated as in ``encode``.
    """
    path = model or model_path()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            found = [own.digest(t) for t in batch.column("text").to_pylist()]
            counts, ids, decoded = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(
        work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
