from pyspark.sql import functions as F

from strandsieve.functions import sequence as Q
from strandsieve.functions.ranking import numbered
from strandsieve.operators import candidates


def sources(spark, *pairs, group=""):
    return spark.createDataFrame([("d", i, group, s) for i, s in pairs], "design_id string, source_sequence_id string, query_group string, sequence string")


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_kmers_are_canonical_and_counted(spark, rows):
    occurrences = candidates.enumerate_kmers(sources(spark, ("a", "ACGTAC"), ("b", "ACGT")), 4)
    assert rows(candidates.kmer_counts(occurrences), "kmer", "source_copy_count") == [("ACGT", 2), ("CGTA", 1), ("GTAC", 1)]
    assert rows(occurrences, "source_sequence_id", "start") == [("a", 0), ("a", 1), ("a", 2), ("b", 0)]


def test_ambiguous_windows_and_short_sources_give_none(spark, rows):
    occurrences = candidates.enumerate_kmers(sources(spark, ("a", "NNACGTT"), ("b", "ACG")), 5)
    assert rows(occurrences, "source_sequence_id", "start", "kmer") == [("a", 2, "AACGT")]


def test_tiles_lose_and_repeat_no_window(spark):
    text = "ACGTTGCATGTCAGTACGATCGTAGCTAGCA" * 7
    for size in (1, 5, 31, 1000):
        got = spark.range(1).select(F.explode(Q.tiles(F.lit(text), 9, size)).alias("t")).select(F.explode(Q.windows(F.col("t"), 9)).alias("w")).collect()
        assert [r.w for r in got] == [text[i : i + 9] for i in range(len(text) - 8)]
    assert one(spark, F.size(Q.tiles(F.lit(""), 9))) == 0


def test_canonical_of_iupac_codes(spark):
    assert one(spark, Q.canonical(F.lit("ARY"))) == one(spark, Q.canonical(F.lit("RYT"))) == "ARY"


def test_entropy(spark):
    assert one(spark, Q.scaled_entropy(F.lit("A" * 31))) == 0
    assert abs(one(spark, Q.scaled_entropy(F.lit("ACGT" * 4))) - 1) < 1e-12
    assert round(one(spark, Q.scaled_entropy(F.lit("ACGTTGCATGTCAGTACGATCGTAGCTAGCA"))), 3) == 0.999


def test_score_text_and_ids(spark):
    for value, text in (("100.10", "100.1"), ("100", "100"), ("0", "0"), (None, ""), ("12.3400", "12.34")):
        assert one(spark, Q.score_text(F.lit(value))) == text
    assert one(spark, Q.padded_id("bait", F.lit(7))) == "bait_000007"
    assert one(spark, Q.padded_id("bait", F.lit(1234567))) == "bait_1234567"
    assert one(spark, Q.stripped_integer(F.lit(75.0))) == "75"
    assert one(spark, Q.stripped_integer(F.lit(97.5))) == "97.5"


def test_representatives_ignore_case_and_strand(spark):
    ids = {one(spark, Q.representative_id(F.lit(s))) for s in ("ACGTA", "TACGT", "acgta")}
    assert len(ids) == 1
    assert next(iter(ids)).startswith("sequence_8be635b3")
    assert one(spark, Q.representative_id(F.lit("CCCCC"))) not in ids


def test_numbers_follow_the_order_whatever_the_partitions(spark):
    names = [("d" if i % 3 else "e", f"{(i * 37) % 101:03d}") for i in range(101)]
    df = spark.createDataFrame(names, "design_id string, kmer string")
    for n in (1, 7):
        got = numbered(df.repartition(n), ["design_id"], "kmer", "number", prefix=1).collect()
        for d in ("d", "e"):
            assert [r.kmer for r in sorted((r for r in got if r.design_id == d), key=lambda r: r.number)] == sorted(k for x, k in names if x == d)


def test_no_python_on_the_candidate_path(spark):
    occurrences = candidates.enumerate_kmers(sources(spark, ("a", "ACGTACGTAAC")), 5)
    manifest = candidates.filter_complexity(candidates.build_manifest(candidates.kmer_counts(occurrences), candidates.background_counts(candidates.kmer_counts(occurrences), sources(spark, ("x", "ACGTA")), 5)), 0.1)
    plan = manifest._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert "Broadcast" in plan


def test_packed_kmers_are_the_canonical_texts(spark):
    import random

    from strandsieve.functions import packed
    from strandsieve.functions.sequence import canonical
    from strandsieve.operators import candidates

    rng = random.Random(2)
    texts = ["", "ACGT", "ACGTNNACGTA", "acgu" * 5, *("".join(rng.choice("ACGTACGTN") for _ in range(rng.randint(0, 90))) for _ in range(20))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, sequence string")
    back = str.maketrans("ACGT", "TGCA")
    for k in (1, 4, 7, 31):
        want = sorted((i, s, min(w, w[::-1].translate(back))) for i, t in enumerate(texts) for s in range(len(t) - k + 1) for w in [t[s : s + k]] if set(w) <= set("ACGT"))
        assert sorted(tuple(r) for r in candidates.enumerate_kmers(df, k, ("i",)).collect()) == want
    one = df.where("i = 4").select(packed.unpack(packed.pack(canonical(F.substring("sequence", 1, 1))), 1).alias("b"))
    assert one.count() == 1


def test_tiles_of_packed_kmers_meet_without_a_gap(spark, monkeypatch):
    from strandsieve.functions import packed

    monkeypatch.setattr(packed, "TILE", 4)
    import numpy as np

    data = np.frombuffer(b"ACGTTGCAACGTNACGGT", np.uint8)
    whole = packed.codes(data, 5, packed._STRICT)
    cut = [packed.codes(data[a : a + 8], 5, packed._STRICT) for a in range(0, 14, 4)]
    assert np.concatenate([c[0] + a for c, a in zip(cut, range(0, 14, 4), strict=True)]).tolist() == whole[0].tolist()
    assert np.concatenate([c[1] for c in cut]).tolist() == whole[1].tolist()
