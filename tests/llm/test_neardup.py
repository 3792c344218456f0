
import re

import pytest
from pyspark.sql import functions as F

from strandsieve.llm import neardup
from strandsieve.llm.components import components

from .conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(find(k), []).append(i)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [x for x in groups[find(k)] if x is not None]
        first = min(ids) if ids and sets[k] else i
        out.append((i, len(sets[k]), first, first is None or i == first))
    return sorted(out, key=repr)


def varied(rng, n):
    """Texts in families with edits of every strength, so that similarities lie around the threshold."""
    rows = []
    for family in range(n):
        base = sentence(rng, rng.choice((3, 8, 30, 60))).split(" ")
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(("new", "NEW", base[0]))
            rows.append((len(rows) * 2 + 1, " ".join(copy)))
        rows.append((len(rows) * 2 + 1, base[0] * (family % 2)))
    rng.shuffle(rows)
    return rows


def test_components_are_those_of_all_pairs(make, rng, rows):
    given = varied(rng, 25)
    assert rows(neardup.near_duplicates(make(*given))) == brute(given)


@pytest.mark.parametrize("crowd", [2, 4])
def test_crowded_regions_are_split_and_still_joined(make, rng, rows, monkeypatch, crowd):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    monkeypatch.setattr(neardup, "PART", 3)
    base = sentence(rng, 80).split(" ")
    given = []
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(80)] = f"w{i}"
        given.append((i, " ".join(copy)))
    assert rows(neardup.near_duplicates(make(*given))) == brute(given)


@pytest.mark.parametrize("crowd", [4, 64])
def test_pairs_at_the_threshold_in_a_crowd_of_one_template(make, rng, rows, monkeypatch, crowd):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    template, given = sentence(rng, 84), []
    for i in range(150):
        shared = sentence(rng, 6)  # 86 of 114 shingles with the partner, 80 of 120 with all others
        given += [(2 * i + k, f"{template} {shared} {sentence(rng, 14)}") for k in range(2)]
    got = rows(neardup.near_duplicates(make(*given)))
    assert got == brute(given)
    assert sum(r[3] for r in got) == 150


@pytest.mark.parametrize(("most", "sent"), [(2, neardup.BROADCAST_BYTES), (32, 0)])
def test_crowd_links_join_all_that_link(make, rng, rows, monkeypatch, most, sent):
    monkeypatch.setattr(neardup, "COMMON", most)
    monkeypatch.setattr(neardup, "BROADCAST_BYTES", sent)
    monkeypatch.setattr(neardup, "GROWTH", 6)
    given = varied(rng, 20)
    lines = [sentence(rng, 12) for _ in range(12)]
    for i in range(60):  # texts of one template's lines, cut down differently and of different lengths
        own = [x for x in lines if rng.random() < 0.85]
        given.append((1001 + 2 * i, " ".join([*own, sentence(rng, rng.choice((0, 3, 20, 45)))])))
    docs = make(*given)
    signed = neardup.signatures(docs).withColumn("_row", F.monotonically_increasing_id()).cache()
    kinds = neardup.classes(signed).cache()
    links = neardup.crowd_links(docs, kinds, kinds.select("node", F.col("node").alias("node_in")))
    name = {r.node: r.least for r in kinds.collect()}
    parent = {i: i for i in name.values()}
    for r in links.collect():
        a, b = (parent[name[x]] for x in (r.u, r.v))
        parent = {k: min(a, b) if v in (a, b) else v for k, v in parent.items()}
    want = {i: c for i, n, c, _ in brute(given) if i in parent}
    assert parent == want


def test_every_planted_pair_among_very_many_of_one_template(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    word = lambda n: " ".join(f"{x:x}" for x in rng.integers(0, 1 << 40, n))
    template, texts = word(304), []
    for _ in range(10_000):
        shared = word(10)  # 310 of 410 shingles with the partner (0.756), 300 of 420 with all others (0.714)
        texts += [f"{template} {shared} {word(50)}" for _ in range(2)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(16)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {i: i - i % 2 for i in range(20_000)}


def test_neighbours_are_those_of_the_sorted_order(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    signs = rng.integers(0, 2, (30, neardup.VALUES))
    light = spark.createDataFrame([(i, 10 + i, [int(x) for x in s]) for i, s in enumerate(signs)], "node long, n long, signature array<int>")
    members = spark.createDataFrame([(i % 3, i, 31, 4) for i in range(30)], "key long, node long, tree int, depth int")
    got = {(r.node, r.hub): (r.n, r.hub_n, r.weight) for r in neardup.neighbours(members, light).collect()}
    want = {}
    for key in range(3):
        rest = {i: [*signs[i], *signs[i]][31 * neardup.DEPTH + 4 :][: neardup.SORTED] for i in range(key, 30, 3)}
        order = sorted(rest, key=lambda i: rest[i])
        for a, b in zip(order, order[1:], strict=False):
            common = next((k for k, (x, y) in enumerate(zip(rest[a], rest[b], strict=True)) if x != y), neardup.SORTED)
            u, v = max(a, b), min(a, b)
            want[u, v] = (10 + u, 10 + v, 4 + common)
    assert got == want


def test_edge_cases(nasty, rows):
    given = [(r.doc_id, r.text) for r in nasty.collect()]
    assert rows(neardup.near_duplicates(nasty)) == brute(given)
    kept = neardup.keep_one(nasty)
    assert kept.columns == nasty.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 10, None, 11, 12}


def test_one_row_of_each_group_is_kept(make, nasty, rng):
    ids = sorted((r.doc_id for r in neardup.keep_one(nasty).collect()), key=repr)
    assert ids == sorted([1, 3, 4, 5, 6, 7, 10, 10, None, None, 11, 12], key=repr)
    a, b, c, d = (sentence(rng, 30) for _ in range(4))
    given = [(1, a), (2, b), (3, b), (3, c), (None, a), (None, d), (None, d), (4, ""), (4, "")]
    got = [(r.doc_id, r.text) for r in neardup.keep_one(make(*given, *given)).collect()]
    assert sorted(got, key=repr) == sorted([(1, a), (2, b), (3, c), (None, d), *[(4, "")] * 4], key=repr)


def test_empty_table(empty):
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.keep_one(empty).count() == 0


def test_components_of_a_chain_and_a_star(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (3, 2), (2, 3)]
    got = dict(rows(components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 1000).astype(np.uint64))
    b = np.concatenate([a[:750], np.unique(rng.integers(0, 1 << 63, 250).astype(np.uint64))])
    same = float((neardup.signature(a) == neardup.signature(b)).mean())
    assert abs(same - 0.6) < 0.15
