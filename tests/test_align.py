"""Native alignment against Smith-Waterman in plain loops."""

from __future__ import annotations

import random

import numpy as np
import pytest

from strandsieve.operators import align

FAR = -(10**9)


def smith_waterman(q, s, sc):
    """All columns of the best local alignment by full matrices; ties as `banded` breaks them."""
    n, m = len(q), len(s)
    h = [[0] * (m + 1) for _ in range(n + 1)]
    e = [[FAR] * (m + 1) for _ in range(n + 1)]
    f = [[FAR] * (m + 1) for _ in range(n + 1)]
    best, at = 0, None
    same = lambda i, j: q[i - 1] == s[j - 1] and q[i - 1] in "ACGT"
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            e[i][j] = max(h[i - 1][j] - sc.opening, e[i - 1][j]) - sc.base
            f[i][j] = max(h[i][j - 1] - sc.opening, f[i][j - 1]) - sc.base
            h[i][j] = max(0, h[i - 1][j - 1] + (sc.match if same(i, j) else sc.mismatch), e[i][j], f[i][j])
            if h[i][j] > best:
                best, at = h[i][j], (i, j)
    if at is None:
        return (0,)
    (i, j), state, columns, wrong, gaps = at, "h", 0, 0, 0
    while True:
        if state == "h":
            if h[i][j] == 0:
                break
            if h[i][j] == h[i - 1][j - 1] + (sc.match if same(i, j) else sc.mismatch):
                columns, wrong, i, j = columns + 1, wrong + (not same(i, j)), i - 1, j - 1
                continue
            state = "e" if h[i][j] == e[i][j] else "f"
        columns += 1
        if state == "e":
            opened = h[i - 1][j] - sc.opening > e[i - 1][j]
            i -= 1
        else:
            opened = h[i][j - 1] - sc.opening > f[i][j - 1]
            j -= 1
        if opened:
            gaps, state = gaps + 1, "h"
    return best, i, at[0], j, at[1], columns, wrong, gaps


def bases(rng, n, letters="ACGT"):
    return "".join(rng.choice(letters) for _ in range(n))


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def as_bytes(s):
    return np.frombuffer(s.encode(), np.uint8)


@pytest.mark.parametrize("scoring", [align.CLOSE, align.WIDE])
def test_wide_bands_give_all_columns_of_smith_waterman(scoring):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        q = bases(rng, rng.randint(1, 30), "ACGTACGTN")
        s = list(q) if rng.random() < 0.6 else list(bases(rng, rng.randint(1, 40), "ACGTN"))
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(s))
            s[at : at + rng.randint(0, 2)] = list(bases(rng, rng.randint(0, 3)))
        pairs.append((q, bases(rng, rng.randint(0, 5)) + "".join(s) + bases(rng, rng.randint(0, 5))))
    got = align.banded([(as_bytes(q), as_bytes(s), -len(q), len(s)) for q, s in pairs], scoring)
    for (q, s), g in zip(pairs, got):
        want = smith_waterman(q, s, scoring)
        assert g[: len(want)] == want or want == (0,), (q, s)


def test_a_band_does_not_depend_on_its_batch():
    rng = random.Random(5)
    pairs = []
    for _ in range(80):
        q = bases(rng, rng.randint(5, 40))
        cut = rng.randint(1, len(q))
        low = rng.randint(-6, 3)
        pairs.append((as_bytes(q), as_bytes(q[:cut] + bases(rng, rng.randint(0, 9)) + q[cut:]), low, low + rng.randint(0, 9)))
    assert align.banded(pairs, align.WIDE) == [align.banded([p], align.WIDE)[0] for p in pairs]


@pytest.mark.parametrize("scoring", [align.CLOSE, align.WIDE])
def test_scores_alone_are_those_of_the_alignments(scoring):
    rng = random.Random(11)
    pairs = [(as_bytes("ACGT" * 4100), as_bytes("ACGT" * 4000), -3, 5)]  # past 16 bits
    for _ in range(300):
        q = bases(rng, rng.randint(1, 90), "ACGTACGTACGTN")
        cut, low = rng.randint(0, len(q)), rng.randint(-40, 3)
        pairs.append((as_bytes(q), as_bytes(bases(rng, rng.randint(0, 9)) + q[:cut] + bases(rng, rng.randint(0, 9), "ACGTN") + q[cut:]), low, low + rng.randint(0, 70)))
    assert align._tops(pairs, scoring) == [align.banded([p], scoring)[0][0] for p in pairs]
    assert align.best_scores(pairs[1:], scoring) == [a[0] for a in align.banded(pairs[1:], scoring)]


def test_only_the_best_subjects_are_traced(spark, rows, monkeypatch):
    rng = random.Random(12)
    genome = bases(rng, 900)
    changed = lambda share: "".join(b if rng.random() > share else bases(rng, 1) for b in genome)
    subjects = {f"s{i}": changed(i % 5 / 60) + "N" * 50 + turned(genome[200:500]) for i in range(10)} | {"same": genome, "equal": genome, "rest": bases(rng, 900)}
    q, s = tables(spark, {"a": genome[100:400], "b": turned(genome[300:800]), "c": bases(rng, 200)}, subjects, own=False)
    whole = align.read_hits(q, s, max_subjects=99)
    want = align.keep_best_subjects(whole, 4)
    traced = []
    regions_of = align._best_of_ends
    monkeypatch.setattr(align, "_best_of_ends", lambda hits: traced.append(hits.select("saccver").distinct().count()) or regions_of(hits))
    got = align.read_hits(q, s, max_subjects=4)
    assert rows(got) == rows(want.select(got.columns)) and got.select("qseqid", "saccver").distinct().count() == 8
    assert traced[0] < whole.select("saccver").distinct().count()


def tables(spark, queries, subjects, own=True):
    q = spark.createDataFrame([("d", n, s) for n, s in queries.items()], "design_id string, query_id string, sequence string")
    rows, ddl = [(n, "7", f"title {n}", s) for n, s in subjects.items()], "saccver string, staxids string, stitle string, sequence string"
    if not own:
        return q.withColumnRenamed("query_id", "representative_id"), spark.createDataFrame(rows, ddl).repartition(3)
    return q, spark.createDataFrame([("d", n, s) for n, s in subjects.items()], "design_id string, assembly_sequence_id string, sequence string").repartition(3)


def test_a_locus_with_an_indel_is_one_hit(spark):
    rng = random.Random(6)
    q = bases(rng, 400)
    edited = q[:120] + "ACG" + q[120:250] + q[253:]  # three bases more, three fewer
    far = bases(rng, 8192 - 100) + edited + bases(rng, 9000)  # over the border of two tiles
    subjects = {"plain": "TT" + q + "GG", "edited": bases(rng, 500) + edited + bases(rng, 90), "far": far, "turned": turned(far), "lower": q.lower().replace("t", "u"), "none": bases(rng, 5000)}
    got = {r.assembly_sequence_id: r for r in align.locus_hits(*tables(spark, {"q": q}, subjects)).collect()}
    assert set(got) == {"plain", "edited", "far", "turned", "lower"}
    for name in ("edited", "far", "turned"):
        r, sequence = got[name], subjects[name] if name != "turned" else far
        want = smith_waterman(q, sequence[max(0, sequence.index(edited) - 50) : sequence.index(edited) + 500], align.CLOSE)
        begin = max(0, sequence.index(edited) - 50)
        place = (begin + want[3] + 1, begin + want[4])
        assert (r.query_start, r.query_end, r.alignment_length) == (want[1] + 1, want[2], want[5]), name
        assert (r.assembly_start_raw, r.assembly_end_raw) == (place if name != "turned" else (len(far) + 1 - place[0], len(far) + 1 - place[1]))
        assert r.percent_identity == pytest.approx(397 / 403 * 100)
    assert (got["plain"].percent_identity, got["lower"].assembly_end_raw, got["plain"].query_length) == (100, 400, 400)


def test_reads_with_indels_are_found_with_all_columns(spark):
    rng = random.Random(7)
    genome = bases(rng, 20_000)
    subjects = {"genome": genome, "kin": "".join(b if rng.random() > 0.08 else bases(rng, 1) for b in genome[3000:6000]), "other": bases(rng, 20_000)}
    reads = {}
    for k in range(12):
        at = rng.randint(3000, 5800)
        part = genome[at : at + 150]
        cut = rng.randint(40, 110)
        part = part[:cut] + ("AC" if k % 3 == 0 else "") + part[cut + (k % 3 == 1) :]
        reads[f"r{k}"] = part if k % 2 else turned(part)
    got = align.read_hits(*tables(spark, reads, subjects, own=False)).collect()
    seen = {(r.qseqid, r.saccver) for r in got}
    assert seen >= {(n, "genome") for n in reads}
    assert not any(s == "other" for _, s in seen)
    assert sum(s == "kin" for _, s in seen) >= 9
    for r in got:
        q = reads[r.qseqid] if r.send > r.sstart else turned(reads[r.qseqid])
        low, high = min(r.sstart, r.send), max(r.sstart, r.send)
        begin = max(0, low - 180)
        want = smith_waterman(q, subjects[r.saccver][begin : high + 180], align.WIDE)
        assert (r.length, r.mismatch, r.gapopen) == want[5:8], r
        assert (low, high) == (begin + want[3] + 1, begin + want[4])
        assert (r.qstart, r.qend) == ((want[1] + 1, want[2]) if r.send > r.sstart else (r.qlen - want[2] + 1, r.qlen - want[1]))
        assert r.bitscore == f"{(want[0] * 0.625 - np.log(0.41)) / np.log(2):.1f}"
        assert (r.staxids, r.stitle, r.evalue < 1e-10) == ("7", f"title {r.saccver}", True)


def test_several_segments_of_a_pair(spark):
    rng = random.Random(8)
    a, b = bases(rng, 120), bases(rng, 100)
    subject = "N".join(["", bases(rng, 50), a, bases(rng, 2000), b, bases(rng, 700), turned(a), a])
    got = align.locus_hits(*tables(spark, {"q": a + "N" * 60 + b}, {"s": subject})).collect()
    found = sorted((r.query_start, r.query_end, r.assembly_start_raw, r.assembly_end_raw) for r in got if r.percent_identity == 100 and r.alignment_length in (100, 120))
    at = [subject.index(a) + 1, subject.index(b) + 1, subject.index(turned(a)) + 1, subject.rindex(a) + 1]
    assert found == sorted([(1, 120, at[0], at[0] + 119), (181, 280, at[1], at[1] + 99), (1, 120, at[2] + 119, at[2]), (1, 120, at[3], at[3] + 119)])


def test_repeats_and_common_words(spark):
    rng = random.Random(9)
    unit, own = bases(rng, 40), bases(rng, 80)
    subjects = {"tandem": unit * 60, "poly": "A" * 3000, **{f"copy{k}": "N".join([bases(rng, 200), unit, own, bases(rng, 200)]) for k in range(20)}}
    queries = {"both": f"{unit}N{own}", "unit": unit, "a": "A" * 60}
    words = align.local_alignments(*[t.withColumnRenamed(x, y) for t, x, y in zip(tables(spark, queries, subjects), ("query_id", "assembly_sequence_id"), ("qseqid", "saccver"))], word=15)
    best = {}
    for r in words.collect():
        best[r.qseqid, r.saccver] = max(best.get((r.qseqid, r.saccver), 0), r.score)
    assert best["unit", "tandem"] == best["both", "tandem"] == 80
    assert best["a", "poly"] == 120
    assert all(best["both", f"copy{k}"] == 236 and best["unit", f"copy{k}"] == 80 for k in range(20))
    few = align.diagonals(*[t.withColumnRenamed(x, y) for t, x, y in zip(tables(spark, queries, subjects), ("query_id", "assembly_sequence_id"), ("qseqid", "saccver"))], 15, common=25).collect()
    # Words of the unit pair the query that has no others, and no more the one that has.
    assert {(r.qseqid, r.saccver) for r in few} == {("both", f"copy{k}") for k in range(20)} | {("unit", s) for s in subjects if s != "poly"} | {("a", "poly")}


def test_word_pairs_over_a_border_of_parts(spark, monkeypatch):
    rng = random.Random(10)
    q = bases(rng, 60)
    subject = bases(rng, 95) + q[:30] + "ACGTACGT" + q[30:] + bases(rng, 95)
    monkeypatch.setattr(align, "_PART", 100)
    monkeypatch.setattr(align, "STRIP", 4)
    hit = max(align.locus_hits(*tables(spark, {"q": q}, {"s": subject}), word=20).collect(), key=lambda r: r.alignment_length)
    assert hit.alignment_length >= 30


def test_nothing_to_align(spark):
    q, s = tables(spark, {"q": "ACGT"}, {"s": "ACGT" * 9})
    assert align.locus_hits(q, s).count() == 0
    assert align.locus_hits(q.limit(0), s).count() == 0
    q, s = tables(spark, {"q": "ACGTTGCA" * 20}, {"s": "ACGT"}, own=False)
    assert align.read_hits(q, s.limit(0)).count() == 0
