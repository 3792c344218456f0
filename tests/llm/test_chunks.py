import hashlib
import random

import numpy as np

from strandsieve.llm import chunks

from .conftest import sentence


def test_ends_are_in_bounds_and_survive_a_shift():
    rng = random.Random(2)
    text = sentence(rng, 3000).encode()
    ends = chunks.chunk_ends(np.frombuffer(text, np.uint8))
    sizes = [b - a for a, b in zip([0, *ends], ends)]  # noqa: B905
    assert ends[-1] == len(text)
    assert all(chunks.SMALLEST <= s <= chunks.LARGEST for s in sizes[:-1])
    shifted = chunks.chunk_set(b"some words before " + text)
    assert chunks.likeness(chunks.chunk_set(text), shifted) > 0.98
    assert chunks.likeness(chunks.chunk_set(text), chunks.chunk_set(sentence(rng, 3000).encode())) < 0.05


def plain_ends(data):
    """The same ends from a rolling hash, byte by byte."""
    ends, start, h = [], 0, 0
    for i, byte in enumerate(data):
        h = ((h << 1) + int(chunks._GEAR[byte])) % (1 << 32)
        size = i + 1 - start
        zeros = chunks.STRICT if size < chunks.NORMAL else chunks.LOOSE
        if i + 1 == len(data) or size == chunks.LARGEST or (size >= chunks.SMALLEST and h >> (32 - zeros) == 0):
            ends.append(i + 1)
            start = i + 1
    return ends


def test_ends_against_a_rolling_hash():
    rng = random.Random(6)
    whole = sentence(rng, 4000).encode()
    for n in (0, 1, 15, 16, 17, 31, 32, 33, 47, 48, 49, 192, 193, 500, len(whole)):
        for data in (whole[:n], b"a" * n, bytes(rng.randrange(256) for _ in range(n))):
            assert chunks.chunk_ends(np.frombuffer(data, np.uint8)) == plain_ends(data)


def test_likeness_of_empty_and_coded_sets():
    a = chunks.chunk_set(b"a text of some length that makes more than one chunk, surely so")
    none = chunks.chunk_set(b"")
    assert chunks.likeness(none, none) == 1
    assert chunks.likeness(a, none) == 0
    assert chunks.likeness(a, a) == 1
    assert (chunks.decode(chunks.encode(a)) == a).all()


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        sets = [chunks.chunk_set(x.encode()) for x in (text, edited, after)]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), chunks.encode(sets[0]), chunks.encode(sets[1]), chunks.likeness(sets[0], sets[1]), chunks.likeness(sets[0], sets[2]))
    return out


def test_edited_texts_take_from_the_next_document(make):
    rng = random.Random(4)
    rows = [(i * 3, sentence(rng, rng.randint(0, 60)) if i % 7 else (None if i % 2 else "é" * i)) for i in range(60)] + [(None, "the last one, without an id")]
    for parts in (1, 5):
        got = chunks.edited_fingerprints(make(*rows, parts=parts)).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: tuple(r)[1:7] for r in got} == brute(rows)


def test_one_document_and_none(make, empty):
    (r,) = chunks.edited_fingerprints(make((5, "abcdef"))).collect()
    assert (r.edited_sha256, r.next_doc_id) == (hashlib.sha256(b"abcdab").hexdigest(), 5)
    assert chunks.edited_fingerprints(empty).count() == 0
    assert chunks.fingerprints(empty).count() == 0


def test_edge_cases(nasty):
    got = chunks.edited_fingerprints(nasty).collect()
    assert len(got) == nasty.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].fingerprint == by[9][0].fingerprint
    assert by[3][0].fingerprint == by[4][0].fingerprint == ""
    assert len(by[10]) == 3
