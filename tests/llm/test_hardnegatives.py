import math
import random
from collections import defaultdict

import numpy as np
import pytest

from strandsieve.llm import hardnegatives

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, n=5, least=80):
    """The contract over all pairs, in plain loops."""
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        kept.append((i, q, (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    last = lambda i: (i is None, i)
    for a, q, label in kept:
        if a is None or a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, p)), last(i), i, other) for i, p, other in kept), key=lambda s: s[:2])
        for s, _, p, _ in [x for x in scored if x[3] == label and x[2] != a][:n]:
            fit = [x for x in scored if x[3] != label and least * -s <= 100 * -x[0] <= 100 * -s][:n]
            out += [(a, p, r, x[2], -s, -x[0]) for r, x in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, parts=3, ddl=ROWS, **more):
    df = spark.createDataFrame(rows, ddl).repartition(parts)
    return sorted((tuple(r) for r in hardnegatives.mine(hardnegatives.quantised(df), **more).collect()), key=repr)


def vectors(rng, n, d=16, spread=1.0, centres=0):
    mid = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(centres)]
    return [(i, [(m + rng.gauss(0, spread)) / 4 for m in (rng.choice(mid) if centres else [0.0] * d)], rng.randrange(10)) for i in range(n)]


@pytest.mark.parametrize(("n", "centres", "spread"), [(700, 0, 1.0), (900, 12, 0.1)])
def test_rows_are_those_of_all_pairs(spark, rng, n, centres, spread):
    rows = vectors(rng, n, spread=spread, centres=centres)
    want = brute(rows, every=20)
    assert len(want) > 100
    assert mined(spark, rows, every=20) == want
    assert mined(spark, rows, every=20, block=20) == want  # many blocks of anchors


def test_ties_repeated_rows_and_a_common_vector(spark, rng):
    rows = vectors(rng, 300)
    same = [0.25] * 16
    rows = [(i, same if i % 3 == 0 else v, label) for i, v, label in rows] + [(i, same, 4) for i in range(0, 60, 3)] + [(None, same, 4), (None, same, 5)]
    assert mined(spark, rows, every=30) == brute(rows, every=30)


def test_rows_that_take_no_part(spark, rng):
    rows = vectors(rng, 300, d=4)
    bad = [(100, None, 1), (200, [1.0] * 4, None), (7, [1.0, None, 1.0, 1.0], 1), (8, [float("nan"), 1.0, 1.0, 1.0], 2), (9, [float("inf"), 1.0, 1.0, 1.0], 2), (10, [float("-inf"), 1.0, 1.0, 1.0], 2)]
    rows += bad
    assert mined(spark, rows, every=50) == brute(rows, every=50)


def test_short_and_empty_vectors_are_continued_by_zeros(spark, rng):
    rows = [(i, v[: rng.randrange(9)], label % 2) for i, v, label in vectors(rng, 200, d=8)]
    full = [(i, v + [0.0] * (8 - len(v)), label) for i, v, label in rows]
    assert mined(spark, rows, every=40) == brute(full, every=40)


def test_extra_columns_and_empty_tables(spark, rng):
    ddl = ROWS + ", v string, d string, lane string, score string, region string, n string, rank string"
    rows = vectors(rng, 200)
    assert mined(spark, [(*r, *["clash"] * 7) for r in rows], ddl=ddl) == brute(rows)
    assert mined(spark, [], ddl=ddl) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchors
    assert mined(spark, [(0, [1.0], 9)]) == []  # an anchor alone


def test_scores_that_a_double_cannot_count_are_an_error(spark):
    with pytest.raises(ValueError, match="too large"):
        mined(spark, [(0, [1e30], 1), (1, [1.0], 1)])


def test_brackets_hold_and_leave_rows_out():
    rng = np.random.default_rng(5)
    x = np.floor(256 * (rng.normal(size=(500, 8)) * 0.05 + rng.normal(size=(10, 8))[rng.integers(0, 10, 500)]))
    q = x[:40]
    most = float((x**2).sum(1).max())
    pivots = hardnegatives.choose_pivots(hardnegatives.augmented(x, most), 8)
    dx, da = hardnegatives.distances(hardnegatives.augmented(x, most), pivots), hardnegatives.distances(np.concatenate([q, np.zeros((40, 1))], 1), pivots)
    s = x @ q.T
    need, high = np.sort(s, axis=0)[-20], s.max(0)
    reach = (q**2).sum(1) + most
    ok = hardnegatives.bracketed(dx, da, np.sqrt(np.maximum(reach - 2 * high, 0)) - 1e-2, np.sqrt(np.maximum(reach - 2 * need, 0)) + 1e-2)
    assert ok[(s >= need) & (s <= high)].all()
    assert ok.mean() < 0.8


def test_best_rows_are_kept_in_order():
    best = hardnegatives.Best(3, 2)
    got = defaultdict(list)
    r = random.Random(2)
    for _ in range(30):
        n = r.randrange(0, 6)
        lane, score, ids = (np.array([r.randrange(m) for _ in range(n)], np.int64) for m in (3, 4, 50))
        best.add(lane, score, ids)
        for a, b, c in zip(lane, score, ids):
            got[int(a)].append((-int(b), int(c)))
    lane, score, ids = best.rows()
    assert [(a, -b, c) for a, b, c in zip(lane.tolist(), score.tolist(), ids.tolist())] == [(a, *x) for a in sorted(got) for x in sorted(got[a])[:2]]
