import random

import pytest

from strandsieve.llm import mixing


def want_targets(sizes):
    """Water-filling in plain Python."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def collection(rng):
    rows = []
    for source, n in (("b", 400), ("a", 60), ("é", 90), (None, 70), ("Z", 1), ("empty", 3)):
        for _ in range(n):
            size = 0 if source == "empty" else rng.choice((0, 1, 5, 20, 20, 300))
            rows.append((len(rows), "w " * size if size else None, source))
    return rows


def test_targets_sums_and_bounds(make, spark):
    given = collection(random.Random(3))
    got = mixing.mix_sizes(make(*given)).collect()
    assert len(got) == len(given)
    source = {i: s for i, _, s in given}
    sizes = {}
    for i, t, s in given:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = want_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(targets[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= (300 if sizes[s] <= 300 else 12)
    again = mixing.mix_sizes(make(*given[::-1], parts=7)).collect()
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in again}


def test_rates_solve_the_dual(make):
    given = collection(random.Random(5))
    got = mixing.mix_sizes(make(*given)).collect()
    source = {i: s for i, _, s in given}
    sums = {}
    for r in got:
        have = sums.setdefault(source[r.doc_id], [0.0, r.target])
        have[0] += r.rate * r.size
        assert 0 <= r.rate <= 2
    assert all(a == pytest.approx(b, rel=1e-4) for a, b in sums.values())


def test_large_groups_of_one_size_are_split(make, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 8)
    rows = [(i, "one two three", "a" if i % 3 else "b") for i in range(500)]
    got = mixing.mix_sizes(make(*rows)).collect()
    for target in {r.target for r in got}:
        assert abs(sum(r.taken for r in got if r.target == target) - target) <= 3


def test_documents_are_repeated_by_copies(make):
    given = collection(random.Random(3))[:300]
    docs = make(*given)
    copies = {r.doc_id: r.copies for r in mixing.mix_sizes(docs).collect()}
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: n for i, n in copies.items() if n}


def test_edge_cases(nasty, empty):
    got = mixing.mix_sizes(nasty)
    assert got.count() == nasty.count()
    assert mixing.mix_documents(nasty).columns == nasty.columns
    assert mixing.mix_documents(nasty).count() == got.agg({"copies": "sum"}).first()[0]
    assert mixing.mix_sizes(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0
