import pytest

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.operators import align, discovery

RULES = "design_id string, query_id string, query_group string, query_start long, query_end long, min_identity double, min_query_coverage double"
HITS = "design_id string, query_id string, query_length long, query_start long, query_end long, assembly_sequence_id string, assembly_start_raw long, assembly_end_raw long, alignment_length long, percent_identity double"


def records(spark, name, *pairs):
    return spark.createDataFrame([("d", i, s) for i, s in pairs], f"design_id string, {name} string, sequence string")


def test_crop(spark, rows):
    rules = spark.createDataFrame([("d", "a", "g", 2, 5, 90.0, 90.0), ("d", "b", "g", 1, 0, 90.0, 90.0)], RULES)
    got = discovery.crop_queries(rules, records(spark, "query_id", ("a", "AACCGG"), ("b", "TTAA")))
    assert rows(got, "query_id", "sequence") == [("a", "ACCG"), ("b", "TTAA")]


@pytest.mark.parametrize("bad", [("d", "a", "g", 2, 9, 90.0, 90.0), ("d", "c", "g", 1, 0, 90.0, 90.0)])
def test_crop_beyond_the_record_or_without_it(spark, bad):
    with pytest.raises(contracts.ContractError):
        discovery.crop_queries(spark.createDataFrame([bad], RULES), records(spark, "query_id", ("a", "AACCGG")))


@pytest.mark.parametrize("bad", [("d", "", "g", 1, 0, 90.0, 90.0), ("d", "a", "", 1, 0, 90.0, 90.0), ("d", "a", "g", 0, 0, 90.0, 90.0), ("d", "a", "g", 5, 2, 90.0, 90.0), ("d", "a", "g", 1, 0, 101.0, 90.0), ("d", "a", "g", 1, 0, 90.0, -1.0)])
def test_rules_are_checked(spark, bad):
    with pytest.raises(contracts.ContractError):
        discovery.check_rules(spark.createDataFrame([bad], RULES))


def loci(spark, *hits, order=1):
    rules = spark.createDataFrame([("d", "q", "g", 1, 0, 98.0, 80.0)], RULES)
    return discovery.candidate_loci(
        spark.createDataFrame([("d", *h) for h in hits][::order], HITS), rules, records(spark, "query_id", ("q", "ACCG")), records(spark, "assembly_sequence_id", ("fwd", "ACCGTT"), ("rev", "NRYT"))
    )


FORWARD, REVERSE = ("q", 4, 1, 4, "fwd", 1, 4, 4, 100.0), ("q", 4, 1, 4, "rev", 4, 1, 4, 99.0)


def test_loci_of_both_strands_and_thresholds(spark, rows):
    short, poor = ("q", 4, 1, 3, "fwd", 1, 3, 3, 100.0), ("q", 4, 1, 4, "fwd", 1, 4, 4, 97.9)
    want = [("candidate_locus_000001", "source_sequence_000001", "+", "ACCG"), ("candidate_locus_000002", "source_sequence_000002", "-", "ARYN")]
    for order in (1, -1):
        got = loci(spark, FORWARD, REVERSE, short, poor, order=order)
        assert rows(got, "candidate_locus_id", "source_sequence_id", "strand", "sequence") == want


@pytest.mark.parametrize(
    "bad",
    [("x", 4, 1, 4, "fwd", 1, 4, 4, 100.0), ("q", 4, 1, 4, "none", 1, 4, 4, 100.0), ("q", 0, 1, 4, "fwd", 1, 4, 4, 100.0), ("q", 5, 1, 4, "fwd", 1, 4, 4, 100.0), ("q", 4, 0, 4, "fwd", 1, 4, 4, 100.0),
     ("q", 4, 1, 4, "fwd", 1, 9, 9, 100.0), ("q", 4, 1, 4, "fwd", 1, 4, 0, 100.0), ("q", 4, 1, 4, "fwd", 1, 4, 4, 101.0), ("q", 4, 1, 4, "fwd", 1, 4, 4, float("nan")), ("q", 4, 1, 4, "fwd", 1, 4, 3, 100.0), ("q", 4, 1, 4, None, 1, 4, 4, 100.0)],
)
def test_hits_are_checked(spark, bad):
    with pytest.raises(contracts.ContractError):
        loci(spark, bad)


def test_groups_without_a_source_end_the_design(spark, rows):
    rules = spark.createDataFrame([("d", "q", "18S", 1, 0, 98.0, 80.0), ("d", "r", "5S", 1, 0, 98.0, 80.0), ("e", "q", "18S", 1, 0, 98.0, 80.0)], RULES)
    found = spark.createDataFrame([("d", "18S", "ACGT"), ("e", "18S", "ACGT")], "design_id string, query_group string, sequence string")
    status = discovery.group_completeness(rules, discovery.provisional_sources(found))
    assert rows(status) == [("d", "18S", S.PASS, 1), ("d", "5S", S.NO_CANDIDATE_LOCUS, 0), ("e", "18S", S.PASS, 1)]
    assert rows(discovery.complete_designs(status)) == [("e",)]


def test_curated_sources(spark, rows):
    got = discovery.curated_sources(spark.createDataFrame([("d", "a", "acgu")], "design_id string, source_sequence_id string, sequence string"))
    assert rows(got, "sequence", "query_group") == [("ACGT", "")]
    for bad in ([("d", "a", "AC-T")], [("d", "", "ACGT")], [("d", "a", "")], [("d", "a", "A"), ("d", "a", "C")], []):
        with pytest.raises(contracts.ContractError):
            discovery.curated_sources(spark.createDataFrame(bad, "design_id string, source_sequence_id string, sequence string"))


def test_native_locus_search(spark, rows):
    query = "ACGTTGCATGTCAGTACGATCGTAGCTAGCATTGACCAG"
    turned = query[::-1].translate(str.maketrans("ACGT", "TGCA"))
    changed = query[:20] + ("A" if query[20] != "A" else "C") + query[21:]
    assembly = records(spark, "assembly_sequence_id", ("plus", "TTTT" + query + "GGGG"), ("minus", "CC" + turned + "A"), ("near", changed), ("none", "ACGT" * 20))
    got = align.locus_hits(records(spark, "query_id", ("q", query)), assembly, word=15)
    n = len(query)
    by = {r.assembly_sequence_id: r for r in got.collect()}
    assert set(by) == {"plus", "minus", "near"}
    assert (by["plus"].assembly_start_raw, by["plus"].assembly_end_raw, by["plus"].percent_identity) == (5, 4 + n, 100)
    assert (by["minus"].assembly_start_raw, by["minus"].assembly_end_raw) == (2 + n, 3)
    assert (by["near"].query_start, by["near"].query_end, round(by["near"].percent_identity, 3)) == (1, n, round((n - 1) / n * 100, 3))


def test_no_hit_carries_its_whole_record(spark, rows):
    """Parts of the records go on to the hits; a record moves once for all hits of it, and repeated hits stay."""
    rules = spark.createDataFrame([("d", "q", "g", 1, 0, 98.0, 80.0)], RULES)
    hits = spark.createDataFrame([("d", *h) for h in (FORWARD, FORWARD, REVERSE, ("q", 4, 1, 4, "fwd", 4, 1, 4, 99.0))], HITS)
    given = (hits, rules, records(spark, "query_id", ("q", "ACCG")), records(spark, "assembly_sequence_id", ("fwd", "accguu" + "A" * 5000), ("rev", "NRYT"), ("none", "ACGT")))
    found = discovery.contextual_hits(*given)
    assert "_assembly" not in found.columns
    assert rows(found, "assembly_sequence_id", "_length", "_part") == [("fwd", 5006, "ACCG")] * 3 + [("rev", 4, "NRYT")]
    accepted = discovery.accepted_loci(*given)
    assert rows(accepted, "strand", "sequence") == [("+", "ACCG"), ("+", "ACCG"), ("-", "ARYN"), ("-", "CGGT")]
    named = discovery.candidate_loci(*given)
    assert rows(discovery.provisional_sources(accepted)) == rows(named.select("design_id", "query_group", "sequence", "source_sequence_id").distinct())
