"""Personal data in very long texts, and shards of the suffix dedup in small memory."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import pii, suffix_dedup

DISGUISE = "write joe [at] site [dot] org "


@pytest.mark.parametrize("unit, size", [
    ("x", 1_000_000), (" ", 1_000_000), ("[", 1_000_000), ("1", 200_000), (".", 200_000),
    ("[ ", 200_000), ("é", 200_000), ("​", 200_000), ("a at ", 200_000), ("1 ", 200_000),
    ("one ", 200_000), ("1.1.", 200_000), ("+1 ", 200_000)])
def test_time_grows_with_the_text_only(unit, size):
    """Long runs beside a disguise; patterns that look back at each place would take hours."""
    text = DISGUISE + unit * (size // len(unit))
    start = time.process_time()
    plain, spans = pii.find_spans(text)
    assert time.process_time() - start < 8
    assert [(s.kind, text[s.start:s.end]) for s in spans if s not in plain][:1] \
        == [("email", "joe [at] site [dot] org")]


def test_many_addresses_in_one_text():
    for unit, kind in ((" joe at site dot org,", "email"), (" 1 dot 2 dot 3 dot 4,", "ip")):
        plain, spans = pii.find_spans(unit * 5_000)
        assert not plain and len(spans) == 5_000 and {s.kind for s in spans} == {kind}


@pytest.mark.parametrize("text, covered", [
    ("a.b dot c.d at x.y", "c.d at x.y"), ("a at b at c.d", "b at c.d"),
    ("a at b.c at d.e", "a at b.c"), ("x dot at at y.z", "x dot at at y.z"),
    ("joe dot a dot b@site punkt org", "joe dot a dot b@site punkt org"),
    ("joe\n at \n site.org", "joe\n at \n site.org"), ("joe at site", None),
    ("at site dot org", None), ("joe [ AT ] site.org", "joe [ AT ] site.org")])
def test_spoken_addresses(text, covered):
    plain, spans = pii.find_spans(text)
    assert [text[s.start:s.end] for s in spans if s not in plain] == ([covered] if covered else [])


def brute_removals(rows):
    """Windows that also start earlier, per anchor."""
    seen = {}
    for anchor, row_id, th, start, body in rows:
        for at in range(len(body) - 99):
            seen.setdefault((anchor, body[at:at + 100]), set()).add((row_id, th, start + at))
    return {place for places in seen.values() for place in places if place != min(places)}


def removed(batches):
    return {(r["id"], r["th"], at) for b in batches for r in b.to_pylist()
            for at in range(r["low"], r["high"] - 99)}


def batch(rows):
    columns = list(zip(*rows))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["hash", "id", "th", "start", "body"])


def test_shards_match_brute_force():
    pick = random.Random(2)
    for _ in range(40):
        rows = []
        for anchor in range(pick.randint(1, 4)):
            basis = [bytes(pick.choices(b"ab", k=200)) for _ in range(2)]
            for k in range(pick.randint(1, 12)):
                at = pick.randint(0, 60)
                body = pick.choice(basis)[at:at + pick.randint(100, 168)]
                if len(body) >= 100:
                    place = (anchor, pick.randint(0, 5), pick.randint(0, 2),
                             pick.randint(0, 3) * 1000 + k * 300)
                    rows += [(*place, body)] * pick.choice([1, 1, 2])
        rows.sort(key=lambda r: (r[0], r[4], *r[1:4]))
        cut = pick.randint(0, len(rows))
        batches = [batch(part) for part in (rows[:cut], rows[cut:]) if part]
        size = pick.choice([1, 500, 1 << 20])
        assert removed(suffix_dedup.shards(iter(batches), size)) == brute_removals(rows)


def test_places_of_a_string_are_never_held():
    """A string in very many places takes one place of a shard."""
    body = bytes(np.random.default_rng(1).integers(97, 120, 120).astype(np.uint8))
    stream = (batch([(7, k, 0, 5, body) for k in range(at, at + 10_000)])
              for at in range(0, 400_000, 10_000))
    rows = sum(b.num_rows for b in suffix_dedup.shards(stream))
    assert rows == 399_999
