import random

import numpy as np
import pytest

from strandsieve.llm import decontaminate

from .conftest import sentence


def items(spark, *pairs):
    return spark.createDataFrame(pairs, "item_id long, text string")


def smith_waterman(a, b):
    best, h = 0, np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (4 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
            best = max(best, h[i, j])
    return best


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 6, rng.integers(1, 25)), rng.integers(0, 6, rng.integers(1, 40))
        assert decontaminate.align(a, b)[0] == smith_waterman(a.tolist(), b.tolist())


def edited(words, every):
    return [("edit" if i % every == every - 1 else w) for i, w in enumerate(words)]


def test_copies_edits_and_clean_documents(spark, make):
    rng = random.Random(9)
    texts = [sentence(rng, n) for n in (12, 40, 60)]
    noise = lambda: sentence(rng, 200)
    w = texts[1].split(" ")
    rows = [
        (1, noise() + " " + texts[0] + " " + noise()), (2, texts[1].upper() + "!"), (3, noise() + " " + ", ".join(edited(w, 8)) + " " + noise()), (4, " ".join(w[:18] + w[20:]) + " " + noise()),
        (5, noise()), (6, " ".join(edited(w, 2))), (7, " ".join(w[:20]) + " " + noise()), (8, texts[2] + " and " + texts[0]),
    ]
    got = decontaminate.leaks(make(*rows), items(spark, *enumerate(texts))).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 0), (2, 1), (3, 1), (4, 1), (8, 0), (8, 2)]
    by = {(r.doc_id, r.item_id): r for r in got}
    assert by[(1, 0)].score == 1
    assert (by[(1, 0)].first_word, by[(1, 0)].end_word) == (200, 212)
    assert 0.75 <= by[(3, 1)].score < 1
    left = decontaminate.without_leaks(make(*rows), items(spark, *enumerate(texts)))
    assert sorted(r.doc_id for r in left.collect()) == [5, 6, 7]


def test_an_item_that_is_everywhere_keeps_its_seeds(spark, make):
    rng = random.Random(11)
    text = sentence(rng, 30)
    rows = [(i, sentence(rng, 20) + " " + text) for i in range(50)]
    assert decontaminate.leaks(make(*rows), items(spark, (1, text))).count() == 50


def test_blocks_of_items_together_find_what_one_does(spark, make, monkeypatch):
    rng = random.Random(12)
    texts = [sentence(rng, 15) for _ in range(9)]
    docs = make(*[(i, t + " " + sentence(rng, 9)) for i, t in enumerate(texts)])
    monkeypatch.setattr(decontaminate.blocks, "__defaults__", (100,))
    assert len(list(decontaminate.blocks(items(spark, *enumerate(texts))))) > 3
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items(spark, *enumerate(texts))).collect()) == [(i, i) for i in range(9)]
    assert decontaminate.without_leaks(docs, items(spark, *enumerate(texts))).count() == 0


def test_edge_cases(spark, nasty, empty):
    bench = items(spark, (1, "one two three four"), (2, None), (3, ""), (4, "one"), (None, "another text under the same id with quite a few words in it"))
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(nasty, bench).collect())
    assert got == [(7, 1), (8, 1), (10, None)] or sorted(got, key=repr) == sorted([(7, 1), (8, 1), (10, None)], key=repr)
    left = decontaminate.without_leaks(nasty, bench)
    assert left.columns == nasty.columns
    assert left.count() == nasty.count() - 3
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(nasty, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(nasty, bench.limit(0)).count() == nasty.count()


@pytest.mark.parametrize("n", [3, 4, 5])
def test_short_items_match_whole(spark, make, n):
    rng = random.Random(n)
    text = sentence(rng, n)
    assert decontaminate.leaks(make((1, sentence(rng, 30) + " " + text), (2, sentence(rng, 30))), items(spark, (5, text))).count() == 1


def inserted(words, every):
    return [x for i, w in enumerate(words) for x in ([w, f"more{i}"] if i % every == every - 1 else [w])]


@pytest.mark.parametrize("exact_copies", [0, 3])
@pytest.mark.parametrize("n", [15, 40, 50])
def test_edited_copies_are_those_of_all_alignments(spark, make, n, exact_copies):
    rng = random.Random(n)
    texts = [sentence(rng, n).split(" ") for _ in range(8)]
    edits = [lambda w: edited(w, 4), lambda w: edited(w, 5), lambda w: edited(w, 6), lambda w: w[: n // 3] + w[n // 3 + n // 6 :]] + [lambda w, e=e: inserted(w, e) for e in (1, 2, 3, 4)]
    around = lambda words: " ".join([sentence(rng, 70), *words, sentence(rng, 70)])
    rows = [(i, around(edit(w))) for i, (edit, w) in enumerate(zip(edits, texts, strict=True))]
    rows += [(100 + i, " ".join(w)) for i, w in enumerate(texts) for _ in range(exact_copies)]
    got = sorted((r.doc_id, r.item_id, r.score) for r in decontaminate.leaks(make(*rows), items(spark, *((k, " ".join(w)) for k, w in enumerate(texts)))).collect())
    scores = [(i, k, smith_waterman(w, text.split(" ")) / (4 * n)) for i, text in rows for k, w in enumerate(texts)]
    assert got == sorted(s for s in scores if s[2] >= 0.75)
    assert sum(i < 100 for i, *_ in got) >= 6


def test_every_alignment_of_the_threshold_has_the_steps(rng):
    """Random edits held against Smith-Waterman: whatever scores 0.75 has so many pairs of the item, at as many places."""
    seen = 0
    for _ in range(4000):
        n = rng.randint(3, 14)
        own = [rng.randrange(40) for _ in range(n)]
        text = [x for w in own for x in ([w] if rng.random() < 0.8 else rng.choice([[], [99], [w, 98], [w, 97, 96]]))]
        text = [rng.randrange(40) for _ in range(3)] + text + [rng.randrange(40) for _ in range(3)]
        if smith_waterman(own, text) >= 3 * n:
            seen += 1
            keys = set(decontaminate._pairs(np.array(own, np.uint64))[0].tolist())
            pairs, at = decontaminate._pairs(np.array(text, np.uint64))
            assert len({p for k, p in zip(pairs.tolist(), at.tolist()) if k in keys}) >= decontaminate.steps(n)
    assert seen > 500


def test_many_items_of_common_words_make_no_pairs_of_everything():
    import time

    rng = np.random.default_rng(4)
    vocabulary = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    text = vocabulary[rng.integers(0, 300, 20_000)]
    took = []
    for n in (2000, 8000):
        words = [vocabulary[rng.integers(0, 300, 8)] for _ in range(n - 1)] + [text[777:785]]
        distinct = np.unique(np.concatenate([decontaminate._pairs(w)[0] for w in words]))
        items = decontaminate.Items(list(range(n)), words, distinct, decontaminate._bits(distinct))
        seeds = decontaminate.Seeds.of(items, np.ones(len(distinct), np.int64))
        began = time.process_time()
        got = list(decontaminate._found(text, items, seeds))
        took.append(time.process_time() - began)
        assert (n - 1, 1.0, 777, 785) in [g[:4] for g in got]
    assert took[1] < 3
