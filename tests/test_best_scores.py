"""Scores without alignments against those of the aligner."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandsieve.operators import align, best_scores
from tests.test_align import as_bytes, bases, tables, turned


@pytest.mark.parametrize("scoring", [align.CLOSE, align.WIDE])
def test_bands_have_the_scores_of_the_aligner(scoring):
    rng = random.Random(21)
    queries, subjects, low, high = ["ACGT" * 4100 + "A", bases(rng, 300)], ["ACGT" * 4100 + "C", ""], [-3, 0], [5, 0]  # past 16 bits; no subject
    for _ in range(300):
        q, at = bases(rng, rng.randint(1, 120), "ACGTACGTACGTN"), rng.randint(-60, 40)
        cut = rng.randint(0, len(q))
        queries.append(q)
        subjects.append(bases(rng, rng.randint(0, 30)) + q[:cut] + bases(rng, rng.randint(0, 9), "ACGTN") + q[cut:])
        low.append(at)
        high.append(at + rng.choice((0, 0, 0, 1, 5, 70)))
    given = best_scores.Bands(np.arange(len(queries)), np.arange(len(queries)), np.array(low), np.array(high))
    texts = [best_scores.Texts([s.encode() for s in x]) for x in (queries, subjects)]
    want = align._tops([(as_bytes(q), as_bytes(s), a - align.BAND, z + align.BAND) for q, s, a, z in zip(queries, subjects, low, high)], scoring)
    assert best_scores.scores(*texts, given, scoring).tolist() == want
    got = best_scores.scores(*texts, given, scoring, least=90).tolist()
    assert [g if g >= 90 else 0 for g in got] == [w if w >= 90 else 0 for w in want] and max(got) > 32_767


@pytest.mark.parametrize("common", [None, 25, 0])
def test_bands_are_the_regions_of_the_aligner(spark, monkeypatch, common):
    rng = random.Random(22)
    monkeypatch.setattr(align, "_PART", 100)
    monkeypatch.setattr(align, "STRIP", 40)
    monkeypatch.setattr(best_scores, "_PAIRS", 500)
    monkeypatch.setattr(best_scores, "_CUT", 100)
    unit, own, part = bases(rng, 40), bases(rng, 80), bases(rng, 16)
    subjects = {"tandem": unit * 20, "poly": "A" * 400, "palindrome": bases(rng, 90) + part + turned(part), "short": "ACG", **{f"copy{k}": "N".join([bases(rng, 90), unit, own[: 15 + k], bases(rng, 99), turned(own)]) for k in range(20)}}
    queries = {"both": f"{unit}N{own}", "unit": unit, "a": "A" * 60, "one": own[:15], "part": part + turned(part), "tiny": "ACGT"}
    q, s = tables(spark, queries, subjects, own=False)
    q = q.withColumnRenamed("representative_id", "qseqid")
    want = {(r.qseqid, r.saccver, r.sstrand, r.low, r.high) for r in align.regions(align.diagonals(q, s, 15, common)).collect()}
    texts = s.select(F.col("saccver").alias("name"), "sequence").where("length(sequence) >= 15")
    frequent = best_scores._common(texts, texts.select("name", F.col("name").alias("saccver")), 15, common)
    names, others = list(queries), list(subjects)
    found = best_scores.bands(best_scores.Texts([x.encode() for x in queries.values()] + [turned(x).encode() for x in queries.values()]), best_scores.Texts([x.encode() for x in subjects.values()]), 15, frequent)
    got = [(names[a % len(names)], others[b], "plus" if a < len(names) else "minus", low, high) for a, b, low, high in zip(*(x.tolist() for x in found))]
    assert set(got) == want and len(got) == len(want) > 60


def best_of(hits):
    return hits.groupBy("design_id", "qseqid", "saccver", "staxids").agg(F.format_string("%.1f", F.max(F.col("bitscore").cast("double"))).alias("bitscore"))


def test_scores_are_those_of_the_best_hits(spark, rows, monkeypatch):
    rng = random.Random(23)
    genome = bases(rng, 900)
    changed = lambda share: "".join(b if rng.random() > share else bases(rng, 1) for b in genome)
    subjects = {f"s{i}": changed(i % 5 / 60) + "N" * 50 + turned(genome[200:500]) for i in range(10)} | {"same": genome, "equal": genome, "b equal": genome.lower(), "rest": bases(rng, 900), "none": "", "far": bases(rng, 7000) + genome[350:700]}
    queries = {"a": genome[100:400], "b": turned(genome[300:800]), "c": bases(rng, 200), "n": genome[:90] + "N" + genome[91:300], "short": "ACG", "none": ""}
    q, s = tables(spark, queries, subjects, own=False)
    s = s.unionByName(spark.createDataFrame([("null", "7", "null", None)], s.schema))
    for letters, most in ((8_000_000, 99), (700, 4)):
        monkeypatch.setattr(best_scores, "LETTERS", letters)
        want = best_of(align.read_hits(q.where("length(sequence) > 0"), s.where("sequence is not null"), most))
        got = best_scores.read_scores(q.where("length(sequence) > 0"), s, most)
        assert rows(got) == rows(want.select(got.columns)) and got.where("qseqid = 'n'").count() == min(13, most)
    monkeypatch.setattr(best_scores, "LONG", 1000)  # a subject beyond it is taken by tiles
    assert rows(best_scores.read_scores(q.where("length(sequence) > 0"), s.where("sequence is not null"), 4)) == rows(got)


def test_repeated_subjects_count_once(spark, rows):
    rng = random.Random(24)
    genome = bases(rng, 600)
    q, s = tables(spark, {"q": genome[100:400]}, {"a": genome, "b": genome[:250] + bases(rng, 300), "c": genome[:200] + bases(rng, 300)}, own=False)
    again = s.unionByName(s).unionByName(spark.createDataFrame([("c", "7", "title c", genome[:300])], s.schema))
    got = [r[2:] for r in rows(best_scores.read_scores(q, again, 2).select("design_id", "qseqid", "saccver", F.col("bitscore").cast("double") > 300))]
    assert got == [("a", True), ("c", True)]  # of two texts with one name the better


def test_nothing_to_score(spark):
    q, s = tables(spark, {"q": "ACGTTGCA" * 20}, {"s": "ACGT"}, own=False)
    assert best_scores.read_scores(q, s).count() == 0
    assert best_scores.read_scores(q, s.limit(0)).count() == 0
    assert best_scores.read_scores(q.limit(0), s).count() == 0
