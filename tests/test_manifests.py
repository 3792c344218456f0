from __future__ import annotations

import pytest

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.operators import manifests

COLUMNS = ("design_id", "row", *S.MANIFEST)
DDL = ", ".join(f"{c} {'long' if c == 'row' else 'string'}" for c in COLUMNS)
KMERS = ["AAAC", "AAAG", "AACC", "ACCA"]


def row(n, kmer, **change):
    values = {
        "design_id": "d", "row": n, "candidate_kmer_id": f"candidate_kmer_{n + 1:06d}", "bait_id": None, "kmer": kmer, "source_copy_count": "2", "background_occurrences": "0",
        "status": S.PASS, "rejection_reason": S.NONE, "taxonomic_screening_status": S.NOT_RUN, "on_target_hits": None, "off_target_hits": None,
    }
    return values | change


BACKGROUND = {"background_occurrences": "3", "status": S.REJECT_BACKGROUND, "rejection_reason": S.BACKGROUND_OCCURRENCE, "taxonomic_screening_status": S.NOT_APPLICABLE}
LOW = {"status": S.REJECT_COMPLEXITY, "rejection_reason": S.LOW_COMPLEXITY, "taxonomic_screening_status": S.NOT_APPLICABLE}
SCREENED = {"bait_id": "bait_000001", "taxonomic_screening_status": S.PASS, "on_target_hits": "4", "off_target_hits": "0"}
OFF = {"bait_id": "bait_000002", "status": S.REJECT_OFF_TARGET, "rejection_reason": S.OFF_TARGET_MATCH, "taxonomic_screening_status": S.REJECT_OFF_TARGET, "on_target_hits": "0", "off_target_hits": "1"}


def table(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], DDL).repartition(3)


def good(stage):
    if stage == manifests.FILTERING:
        return [row(0, KMERS[0]), row(1, KMERS[1], **BACKGROUND), row(2, KMERS[2])]
    if stage == manifests.SCREENING:
        return [row(0, KMERS[0], bait_id="bait_000001"), row(1, KMERS[1], **BACKGROUND), row(2, KMERS[2], **LOW), row(3, KMERS[3], bait_id="bait_000002")]
    return [row(0, KMERS[0], **SCREENED), row(1, KMERS[1], **BACKGROUND), row(2, KMERS[2], **OFF), row(3, KMERS[3], **LOW)]


@pytest.mark.parametrize("stage", [manifests.FILTERING, manifests.SCREENING, manifests.VERIFICATION])
def test_good_manifests_are_taken_in(spark, stage, monkeypatch):
    got = manifests.check_manifest(table(spark, good(stage)), stage, 4)
    assert got.columns == ["design_id", *S.MANIFEST]
    assert got.where("bait_id is null or source_copy_count <> 2").count() == 0
    assert got.count() == len(good(stage))


COMMON = [
    ({"kmer": None}, "missing field"), ({"status": ""}, "missing field"), ({"candidate_kmer_id": "candidate_kmer_000009"}, "non-sequential"), ({"kmer": "AAAA"}, "not sorted"),
    ({"kmer": "TTTT"}, "noncanonical"), ({"kmer": "AAAC"}, "duplicate k-mer AAAC"), ({"source_copy_count": "0"}, "source_copy_count"), ({"source_copy_count": "x"}, "source_copy_count"),
    ({"background_occurrences": "-1"}, "background_occurrences"), ({"background_occurrences": "0"}, "state for"), ({"status": "OTHER"}, "state for"), ({"rejection_reason": S.NONE}, "state for"),
]
CASES = [
    *[(stage, change, message) for stage in (manifests.FILTERING, manifests.SCREENING, manifests.VERIFICATION) for change, message in COMMON],
    *[(stage, {"kmer": "AANG"}, "invalid k-mer AANG") for stage in (manifests.FILTERING, manifests.SCREENING)],
    (manifests.VERIFICATION, {"kmer": "AANG"}, "invalid identity or k-mer AANG"), (manifests.VERIFICATION, {"candidate_kmer_id": "k1"}, "invalid identity"),
    (manifests.FILTERING, {"bait_id": "bait_000001"}, "evidence before"), (manifests.SCREENING, {"on_target_hits": "1"}, "hits before screening"), (manifests.SCREENING, {"bait_id": "bait_000001"}, "duplicate panel id bait_000001"),
    (manifests.VERIFICATION, {"bait_id": "bait_000001"}, "duplicate panel id bait_000001"), (manifests.VERIFICATION, {"off_target_hits": "1"}, "incoherent state"), (manifests.VERIFICATION, {"bait_id": "bait_000007"}, "incoherent state"),
]


@pytest.mark.parametrize("stage", [manifests.FILTERING, manifests.SCREENING, manifests.VERIFICATION])
def test_each_check_in_order(spark, stage):
    """Each case spoils the second row; what a check before it would say first is not spoiled."""
    for s, change, message in CASES:
        if s == stage:
            rows = good(stage)
            rows[1] = rows[1] | change
            with pytest.raises(contracts.ContractError, match=message):
                manifests.check_manifest(table(spark, rows), stage, 4)


def test_the_first_bad_row_and_the_earlier_check_decide(spark):
    rows = good(manifests.SCREENING)
    rows[3] = rows[3] | {"status": None}
    rows[2] = rows[2] | {"source_copy_count": "0", "background_occurrences": "x"}
    with pytest.raises(contracts.ContractError, match="source_copy_count for candidate_kmer_000003"):
        manifests.check_manifest(table(spark, rows), manifests.SCREENING, 4)
    for bad, message in (([], "no rows"), ([row(0, "AAAC", **BACKGROUND)], "no eligible k-mer in d"), ([row(0, "AAAC"), row(1, "AACCC")], "different lengths")):
        with pytest.raises(contracts.ContractError, match=message):
            manifests.check_manifest(table(spark, bad), manifests.FILTERING)


def test_panel_records(spark):
    ddl = "design_id string, id string, description string, sequence string, row long"
    rows = [("d", f"bait_{i + 1:06d}", "", s, i) for i, s in enumerate(KMERS)]
    assert manifests.check_panel_records(spark.createDataFrame(rows, ddl), 4).count() == 4
    bad = [
        ((1, 1, ""), "invalid id"), ((1, 2, "more"), "invalid id"), ((1, 1, "bait_000001"), "duplicate id"), ((1, 3, "AAAC"), "duplicate sequence"), ((1, 3, "AAACC"), "malformed 4-mer"), ((1, 3, "aaag"), "malformed 4-mer"),
        ((1, 3, "TTTG"), "noncanonical"), ((1, 1, "bait_000009"), "not sequential"), ((1, 3, "AAAA"), "not sorted"),
    ]
    for (at, column, value), message in bad:
        changed = [tuple(value if (i, j) == (at, column) else x for j, x in enumerate(r)) for i, r in enumerate(rows)]
        with pytest.raises(contracts.ContractError, match=message):
            manifests.check_panel_records(spark.createDataFrame(changed, ddl), 4)
    with pytest.raises(contracts.ContractError, match="no rows"):
        manifests.check_panel_records(spark.createDataFrame([], ddl), 4)


def test_query_groups(spark, rows):
    sources = spark.createDataFrame([("d", "a"), ("d", "b")], "design_id string, source_sequence_id string")
    put = lambda *r: spark.createDataFrame([("d", *x, i) for i, x in enumerate(r)], "design_id string, source_sequence_id string, query_group string, row long")
    assert rows(manifests.check_query_groups(put(("a", None), ("b", "18S")), sources)) == [("d", "a", ""), ("d", "b", "18S")]
    for bad, message in (([("", "x"), ("b", "x")], "blank"), ([("a", "x"), ("a", "y")], "duplicate source sequence id a"), ([("a", "x")], "no group.*=b"), ([("a", ""), ("b", ""), ("c", "")], "no source.*=c")):
        with pytest.raises(contracts.ContractError, match=message):
            manifests.check_query_groups(put(*bad), sources)


def test_panel_status(spark):
    values = ["d", S.CURATED, "10", "4", S.NOT_RUN, "", "locally_filtered", ""]

    def status(change=None, drop=0):
        kept = list(zip(manifests.STATUS_METRICS, [change.get(n, v) if change else v for n, v in zip(manifests.STATUS_METRICS, values)]))[drop:]
        return spark.createDataFrame([("d", i, m, v or None) for i, (m, v) in enumerate(kept)], "design_id string, ordinal int, metric string, value string")

    assert manifests.check_set_status(status()).first().candidate_kmer_count == "10"
    screened = {"taxonomic_screening_status": S.PASS, "taxonomically_screened_bait_count": "3", "deepest_bait_set": "taxonomically_screened"}
    assert manifests.check_set_status(status(screened)).count() == 1
    bad = [
        ({"design_id": "e"}, "another design"), ({"source_sequence_origin": "x"}, "unsupported"), ({"candidate_kmer_count": "01"}, "candidate_kmer_count"), ({"locally_filtered_bait_count": ""}, "locally_filtered"),
        ({"taxonomically_screened_bait_count": "-1"}, "taxonomically_screened"), ({"candidate_kmer_count": "9" * 30}, "candidate_kmer_count"), ({"deacon_index_source": "locally_filtered"}, "index before"),
        ({"taxonomic_screening_status": S.PASS}, "incoherent"), (screened | {"taxonomically_screened_bait_count": "0"}, "incoherent"), ({"taxonomic_screening_status": S.STAGE_EMPTY_PANEL}, "incoherent"),
    ]
    for change, message in bad:
        with pytest.raises(contracts.ContractError, match=message):
            manifests.check_set_status(status(change))
    with pytest.raises(contracts.ContractError, match="unexpected metrics"):
        manifests.check_set_status(status(drop=1))
