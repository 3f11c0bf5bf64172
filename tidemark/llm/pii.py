"""Personal data in plain and in disguised form, with spans in the source text.

Plain identifiers are found by four patterns. Disguised ones are found in a normalised text that
a chain of transducers makes: look-alike letters become ASCII and invisible ones vanish, digits
spelled as words become digits, and written-out "at" and "dot" become signs. Every transducer
copies the source position of each character it emits, so a match in the normalised text is
mapped back to the characters it came from. Only matches that touch a rewritten place and no
plain match are added.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import id_and_text

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


# ---------------------------------------------------------------------------------------------
# Plain identifiers
# ---------------------------------------------------------------------------------------------
# Possessive repeats and look-behinds keep each scan linear without changing what matches.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_BACKWARDS = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")
_RUN = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TWELVE = re.compile(r"[0-9](?:[ -]?[0-9]){11}")


def emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL_BACKWARDS.fullmatch(text, start - 1, start):
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield Span("email", start, done)
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", at + 1)


def addresses(text: str) -> Iterator[Span]:
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255
               for part in match[0].split(".")):
            yield Span("ip", *match.span())


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    if not _TWELVE.search(text):
        return
    for match in _RUN.finditer(text):
        if 12 <= match.end() - match.start() <= 37:
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                yield Span("card", *match.span())


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for match in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
            yield Span("phone", *match.span())


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def plain_spans(text: str) -> list[Span]:
    return _ordered([*emails(text), *addresses(text), *cards(text), *phones(text)])


# ---------------------------------------------------------------------------------------------
# Transducers: characters, and where in the source each begins and ends
# ---------------------------------------------------------------------------------------------
class Mapped(NamedTuple):
    text: str
    starts: list[int]
    ends: list[int]
    changed: list[bool]


# Letters of other scripts that look like ASCII letters.
_LOOKALIKES = dict(zip(
    "аеорсухкмтнвіјѕԁһԛԝАЕОРСУХКМТНВІЈЅαονρικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ∙•。．＠",
    "aeopcyxkmthbijsdhqwAEOPCYXKMTHBIJSaovpiktuxABEZHIKMNOPTYX....@"))
_INVISIBLE = "­​‌‍‎‏⁠﻿"
# Digit names in the four languages of the corpus.
_DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "une": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5",
    "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_NAME = "|".join(sorted(_DIGIT_NAMES, key=len, reverse=True))
_DIGIT = rf"(?:[0-9]|\b(?:{_NAME})\b)"
_SPELLED = re.compile(rf"(?:\b(?:plus)\b\s?)?{_DIGIT}(?:[ ,-]{{0,2}}{_DIGIT}){{6,}}", re.I)
#: Four numbers of at most three digits, names or figures, with dot signs between them.
_DOT = (r"(?:\s*[\[({<]\s*(?:dot|punkt|punto|point)\s*[\])}>]\s*"
        r"|\s+(?:dot|punkt|punto|point)\s+|\.)")
_PART = rf"{_DIGIT}(?:[ ,-]{{0,2}}{_DIGIT}){{0,2}}"
_SPELLED_IP = re.compile(rf"({_PART}){_DOT}({_PART}){_DOT}({_PART}){_DOT}({_PART})", re.I)
_ONE_NAME = re.compile(rf"\b(?:{_NAME}|plus)\b", re.I)
_BRACKETED = re.compile(
    r"[\[({<]\s*(?P<b>at|arroba|chez|dot|punkt|punto|point)\s*[\])}>]\s*", re.I)
_BARE = re.compile(
    r"(?<=[A-Za-z0-9])\s+(?P<w>at|arroba|dot|punkt|punto|point)\s+(?=[A-Za-z0-9])", re.I)
_ATS = {"at", "arroba", "chez"}
_DOTS = {"dot", "punkt", "punto", "point"}
#: Runs of the characters of an address before its at sign, and what has to follow the sign.
_SAID_RUN = re.compile(r"[A-Za-z0-9._%+-]+", re.I)
_SAID_DOMAIN = re.compile(
    r"[A-Za-z0-9-]+(?:(?:\.|\s+(?:dot|punkt|punto|point)\s+)[A-Za-z0-9-]+)+", re.I)
_BARE_IP = re.compile(r"(?<![0-9])[0-9]+(?:(?:\.|\s+(?:dot|punkt|punto|point)\s+)[0-9]+){3}", re.I)
_HINT = re.compile(
    rf"[{re.escape(''.join(_LOOKALIKES))}{_INVISIBLE}！-～\U0001d400-\U0001d7ff]"
    r"|[\[({<]\s*(?:at|arroba|chez|dot|punkt|punto|point)\s*[\])}>]"
    r"|\s(?:at|arroba|dot|punkt|punto|point)\s+[A-Za-z0-9-]+\s*(?:\.|\s(?:dot|punkt|punto|point)\s)"
    r"|@[A-Za-z0-9.-]+\s+(?:dot|punkt|punto|point)\s"
    r"|[0-9]\s+(?:dot|punkt|punto|point)\s+[0-9]",
    re.I)


def _names_digits(text: str) -> bool:
    """Whether digits are spelled; nearly every text is settled without the long pattern."""
    words = text.lower().replace(",", " ").replace("-", " ").replace(".", " ").split()
    return (not _DIGIT_NAMES.keys().isdisjoint(words)
            and bool(_SPELLED.search(text) or _SPELLED_IP.search(text)))


def _source(text: str) -> Mapped:
    size = len(text)
    return Mapped(text, [*range(size)], [*range(1, size + 1)], [False] * size)


@cache
def _plain_letter(letter: str) -> str:
    """The ASCII form of one character, empty if it is invisible, itself if it has none."""
    if letter in _INVISIBLE:
        return ""
    if letter in _LOOKALIKES:
        return _LOOKALIKES[letter]
    if "！" <= letter <= "～" or "\U0001d400" <= letter <= "\U0001d7ff":
        folded = unicodedata.normalize("NFKC", letter)
        return folded if folded.isascii() else letter
    return letter


def _rewrite(given: Mapped, edits: list[tuple[int, int, str]]) -> Mapped:
    """Replace ranges of the text; what is put in stands for the whole range it replaces."""
    if not edits:
        return given
    letters, starts, ends, changed, at = [], [], [], [], 0
    for start, end, new in [*edits, (len(given.text), len(given.text), "")]:
        letters.append(given.text[at:start])
        starts += given.starts[at:start]
        ends += given.ends[at:start]
        changed += given.changed[at:start]
        for piece in new:
            letters.append(piece)
            starts.append(given.starts[start])
            ends.append(given.ends[end - 1])
            changed.append(True)
        at = end
    return Mapped("".join(letters), starts, ends, changed)


_NOT_ASCII = re.compile(r"[^\x00-\x7f]")


def fold_lookalikes(given: Mapped) -> Mapped:
    edits = [(m.start(), m.end(), plain) for m in _NOT_ASCII.finditer(given.text)
             if (plain := _plain_letter(m[0])) != m[0]]
    out = _rewrite(given, edits)
    # An invisible character inside a word marks its neighbours as changed.
    longer = 0
    for start, end, new in edits:
        at = start + longer
        longer += len(new) - (end - start)
        if not new and 0 < at < len(out.text):
            out.changed[at] = out.changed[at - 1] = True
    return out


def _digit_edits(text: str, begin: int, end: int) -> Iterator[tuple[int, int, str]]:
    """Edits that turn the digit names of one run into digits that stand together."""
    run = text[begin:end]
    names = [*_ONE_NAME.finditer(run)]
    for name in names:
        word = name[0].lower()
        yield (begin + name.start(), begin + name.end(),
               "+" if word == "plus" else _DIGIT_NAMES[word])
    if names:
        for blank in re.finditer(r"(?<=[a-z])[ ,-]{1,2}(?=[a-z0-9])|(?<=[0-9])[ ,-]{1,2}(?=[a-z])",
                                 run, re.I):
            yield begin + blank.start(), begin + blank.end(), ""


def spelled_digits(given: Mapped) -> Mapped:
    """Long runs of digits, and short ones that dot signs join to an ip."""
    runs = [m.span() for m in _SPELLED.finditer(given.text)]
    runs += [m.span(part) for m in _SPELLED_IP.finditer(given.text) for part in range(1, 5)]
    return _rewrite(given, sorted({edit for run in runs for edit in _digit_edits(given.text, *run)}))


def _sign(word: str) -> str:
    return "@" if word.lower() in _ATS else "."


def _bracketed_signs(text: str) -> Iterator[tuple[int, int, str]]:
    """Signs in brackets with the blanks around them."""
    before = 0
    for sign in _BRACKETED.finditer(text):
        start = before + len(text[before:sign.start()].rstrip())
        yield start, sign.end(), _sign(sign["b"])
        before = sign.end()


def _spoken_addresses(text: str) -> list[tuple[int, int]]:
    """Addresses whose at sign, or dots, may be bare words.

    Read from each at sign: to the right a domain has to follow, and to the left the words that
    dots join to the last one belong to it. Every run of characters is looked at a few times,
    however long it is.
    """
    runs = [m.span() for m in _SAID_RUN.finditer(text)]

    def blank(first: int) -> bool:
        """Whether only blanks are between a run and the next one."""
        return text[runs[first][1]:runs[first + 1][0]].isspace()

    def signs() -> Iterator[tuple[int, int]]:
        """The run before an at sign, and where the domain has to start."""
        for k, (start, end) in enumerate(runs):
            if text.startswith("@", end):
                yield k, end + 1
            if (0 < k < len(runs) - 1 and end - start <= 6 and text[start:end].lower() in _SAID_AT
                    and blank(k - 1) and blank(k)):
                yield k - 1, runs[k + 1][0]

    found: list[tuple[int, int]] = []
    for last, after in sorted(signs(), key=lambda sign: sign[1]):
        first, free = last, found[-1][1] if found else 0
        domain = _SAID_DOMAIN.match(text, after) if runs[last][1] > free else None
        if domain is None:
            continue
        # A word behind a dot has no further dot in it; the first one may.
        while (first >= 2 and runs[first][0] >= free and runs[first - 2][1] > free
               and "." not in text[slice(*runs[first])]
               and text[slice(*runs[first - 1])].lower() in _DOTS
               and blank(first - 2) and blank(first - 1)):
            first -= 2
        found.append((max(runs[first][0], free), domain.end()))
    return found


_SAID_AT = {"at", "arroba"}


def at_and_dot(given: Mapped) -> Mapped:
    """Bracketed signs always; bare words only where they then make up a whole address."""
    given = _rewrite(given, [*_bracketed_signs(given.text)])
    whole = [_spoken_addresses(given.text), [m.span() for m in _BARE_IP.finditer(given.text)]]
    starts = [[low for low, _ in spans] for spans in whole]

    def inside(start: int, end: int) -> bool:
        return any((k := bisect_right(lows, start)) and end <= spans[k - 1][1]
                   for lows, spans in zip(starts, whole))

    return _rewrite(given, [(*sign.span(), _sign(sign["w"]))
                            for sign in _BARE.finditer(given.text) if inside(*sign.span())])


def disguised_spans(text: str, plain: list[Span]) -> list[Span]:
    """Matches of the normalised text at rewritten places, apart from the plain ones."""
    if not (_HINT.search(text) or _names_digits(text)):
        return []
    mapped = at_and_dot(spelled_digits(fold_lookalikes(_source(text))))
    taken = sorted((s.start, s.end) for s in plain)
    starts = [start for start, _ in taken]
    ends = [0, *accumulate((end for _, end in taken), max)]       # of the spans so far
    found: list[Span] = []
    last = 0
    for kind, low, high in plain_spans(mapped.text):
        if not any(mapped.changed[low:high]):
            continue
        start, end = min(mapped.starts[low:high]), max(mapped.ends[low:high])
        # Matches come by their start, so of those found before only the furthest end counts.
        if ends[bisect_left(starts, end)] <= start and last <= start:
            found.append(Span(kind, start, end))
            last = end
    return found


# ---------------------------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------------------------
def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans."""
    plain = plain_spans(text) if _ANY.search(text) else []
    return plain, _ordered(plain + disguised_spans(text, plain))


_ANY = re.compile(r"[@0-9]")


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def detect(docs: DataFrame) -> DataFrame:
    """One row per document with the counts of plain spans and all spans.

    Columns: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added. A null or
    empty text has no spans; repeated rows are reported each; other columns are ignored; an
    empty table gives no rows. Spans count code points, ends exclusive. Spans of different kinds
    may overlap. Texts are searched whole, in time linear in their length unless a disguise is
    found.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t) for t in batch.column("text").to_pylist()]
            counts = [pa.array([sum(s.kind == kind for s in plain) for plain, _ in found],
                               pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts,
                 pa.array([sha256(written(plain).encode()).hexdigest() for plain, _ in found],
                          pa.string()),
                 pa.array([written(every) for _, every in found], pa.string()),
                 pa.array([len(every) - len(plain) for plain, every in found], pa.int64())],
                ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"])

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return id_and_text(docs).mapInArrow(
        run, f"doc_id bigint, {counts}, base_sha256 string, spans string, n_added bigint")


def mask(docs: DataFrame) -> DataFrame:
    """The documents with identifiers in ``text`` replaced by their kind, as ``<email>``.

    All columns and rows stay; ``n_chars``, if there, is the new length. Null texts stay null.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and masked(t, find_spans(t)[1])
                     for t in batch.column("text").to_pylist()]
            new = {"text": texts}
            if "n_chars" in batch.schema.names:
                new["n_chars"] = [old if t is None else len(t) for t, old in
                                  zip(texts, batch.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name)
                 for f in batch.schema], schema=batch.schema)

    return docs.mapInArrow(run, schema)
