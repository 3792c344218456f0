import hashlib
import random
import re

import pytest

from strandsieve.llm import substrings

from .conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    firsts, words = {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = WORD.findall(text or "")
        words.append((i, w))
        for j in range(len(w) - 19):
            at = (i is not None, i or 0, j)
            key = tuple(w[j : j + 20])
            firsts[key] = min(firsts.get(key, at), at)
    out = []
    for i, w in words:
        gone = bytearray(len(w))
        for j in range(len(w) - 19):
            if firsts[tuple(w[j : j + 20])] != (i is not None, i or 0, j):
                gone[j : j + 20] = b"\1" * 20
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def shared(rng, n):
    """Documents with passages in common, at all offsets, some just under and over a window, some within one document."""
    passages = [sentence(rng, k).split(" ") for k in (19, 20, 21, 35, 60)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += sentence(rng, rng.randint(0, 30)).split(" ")
            p = rng.choice(passages)
            words += p if rng.random() < 0.7 else p[rng.randint(0, 5) :]
        rows.append((i * 2, "\n".join(words) if i % 3 else " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [2000, 3])
def test_removed_words_are_those_of_all_windows(make, rng, rows, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    given = shared(rng, 40)
    assert rows(substrings.without_repeats(make(*given)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute(given)


def test_periodic_text(make, rows):
    given = [(1, "a " * 100), (2, "a b " * 50), (3, "a " * 19), (4, "b a " * 11)]
    assert rows(substrings.without_repeats(make(*given)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute(given)


def test_rows_that_share_a_doc_id_lose_only_what_they_repeat(make, rng, rows):
    passage, other, third = (sentence(rng, 40) for _ in range(3))
    given = [(1, passage), (2, passage), (2, other), (2, f"{sentence(rng, 7)} {other}"), (2, other), (None, third), (None, passage), (3, f"{third} {other}")]
    got = rows(substrings.without_repeats(make(*given)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute(given)
    assert sorted(r[2] for r in got if r[0] == 2) == [0, 0, 40, 40]


def test_edge_cases(nasty, rows):
    given = [(r.doc_id, r.text) for r in nasty.collect()]
    assert rows(substrings.without_repeats(nasty), "doc_id", "n_words", "n_removed", "kept_sha256") == brute(given)


def test_empty_table(empty):
    assert substrings.without_repeats(empty).count() == 0


def test_factors_are_greedy_and_their_ends_are_checked():
    import numpy as np

    starts = np.array([0, 1, 2, 20, 21, 30, 31, 60])
    spans, factors = substrings.parse(starts, np.array([7, 7, 8, 8, 8, 7, 7, 7]), np.array([5, 6, 0, 9, 10, 9, 10, 90]))
    # The first factor ends behind word 20; the windows at 2 and 20 straddle that end, the next factor starts at 21.
    assert factors == [(0, 21, 7, 5), (21, 41, 8, 10), (60, 80, 7, 90)]
    assert spans == [(0, 51), (60, 80)]
    assert substrings.parse(starts[:0], starts[:0], starts[:0]) == ([], [])


def test_spans_come_from_the_factors(monkeypatch, make, rng, rows):
    passage = sentence(rng, 60)
    given = [(1, passage), (2, passage)]
    monkeypatch.setattr(substrings, "parse", lambda starts, *_: ([], []))
    assert [r[2] for r in rows(substrings.without_repeats(make(*given)), "doc_id", "n_words", "n_removed")] == [0, 0]
    monkeypatch.undo()
    (_, one), (_, two) = rows(substrings.without_repeats(make(*given)), "doc_id", "n_factors")
    assert (one, two) == (0, 1)


def test_windows_of_equal_words_share_their_anchor():
    from strandsieve.llm.bytescan import WordHasher

    import numpy as np

    rng = random.Random(5)
    text = sentence(rng, 200)
    data = np.frombuffer(text.encode(), np.uint8)
    from strandsieve.llm.bytescan import words

    starts, ends, _ = words(data, np.array([0, len(data)]))
    hashes = WordHasher(71)(data, starts, ends)
    least, grams = substrings.window_anchors(hashes)
    assert len(least) == len(hashes) - 19
    assert all(least[i] == grams[i : i + 13].min() for i in range(len(least)))
