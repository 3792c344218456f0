from strandsieve.plans.design import Inputs, Parameters, run_designs
from strandsieve.streaming.reads import stream_read_counts

SOURCE = "ACGTTGCATGTCAGTACGATCGTAGCTAGCATTGACCAGGTCATTACGGA"
OTHER = "TTGACCGATAGCTCAGGATCTCTAGGCATCCGATTACAGCATGCAAGTCCAT"


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def inputs(spark):
    designs = spark.createDataFrame([("a", "1"), ("b", "1")], "design_id string, target_taxid string")
    curated = spark.createDataFrame([("a", "s", SOURCE)], "design_id string, source_sequence_id string, sequence string")
    rules = spark.createDataFrame([("b", "q", "g", 1, 0, 90.0, 90.0)], "design_id string, query_id string, query_group string, query_start long, query_end long, min_identity double, min_query_coverage double")
    records = spark.createDataFrame([("b", "q", OTHER)], "design_id string, query_id string, sequence string")
    assembly = spark.createDataFrame([("b", "asm", "GG" + turned(OTHER) + "CC")], "design_id string, assembly_sequence_id string, sequence string")
    background = spark.createDataFrame([("a", SOURCE[:25]), ("b", "A" * 40)], "design_id string, sequence string")
    reference = spark.createDataFrame([("r1", "1", "n", "t", SOURCE), ("r2", "2", "n", "t", "CC" + SOURCE[27:48]), ("r3", "1", "n", "t", OTHER)], "saccver string, staxids string, sscinames string, stitle string, sequence string")
    reads = [("a", "m", i, s) for i, s in enumerate((SOURCE, turned(SOURCE), "G" * 50))] + [("b", "m", 0, OTHER)]
    return Inputs(designs, background, curated, rules, records, assembly, reference=reference, reads=spark.createDataFrame(reads, "design_id string, metagenome_id string, ordinal long, sequence string"))


def test_two_designs_in_one_run(spark, tmp_path):
    run = run_designs(inputs(spark), Parameters(kmer_size=21, entropy_threshold=0.5))
    t = {k: v.collect() for k, v in run.tables.items()}
    a = [r for r in t["screened_manifest"] if r.design_id == "a"]
    assert len(a) == len(SOURCE) - 20
    assert sum(r.status == "REJECT_INTERFERENCE_BACKGROUND" for r in a) == 5
    assert sum(r.status == "REJECT_OFF_TARGET_HIT" for r in a) == 1
    assert {r.source_sequence_id for r in t["sources"] if r.design_id == "b"} == {"source_sequence_000001"}
    assert [r.sequence for r in t["sources"] if r.design_id == "b"] == [OTHER]
    assert not t["index_errors"]
    assert {(r.design_id, r.read_id, r.classification) for r in t["classified_reads"]} == {("a", "read_000000000001", "TARGET"), ("a", "read_000000000002", "TARGET"), ("b", "read_000000000001", "TARGET")}
    status = {(r.design_id, r.metric): r.value for r in t["threshold_summary"]}
    assert status[("a", "calibration_status")] == "RECOMMENDED_THRESHOLD"
    assert status[("a", "duplicate_sequence_count")] == "1"
    assert run.steps == ["curated_sources", "discovered_sources", "candidate_kmers", "complexity_filter", "taxonomic_screening", "verified_index", "calibration"]
    run.write(str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/04_bait_sets/panel")).count() == len(t["panel"])
    assert not (tmp_path / "out/05_index/index_errors").exists()


def test_reads_are_counted_as_they_arrive(spark, tmp_path):
    panel = spark.createDataFrame([("a", "bait_000001", SOURCE[:21])], "design_id string, bait_id string, sequence string")
    one = spark.createDataFrame([("a", "m1", 0, SOURCE)], "design_id string, metagenome_id string, ordinal long, sequence string")
    two = spark.createDataFrame([("a", "m2", 0, SOURCE), ("a", "m2", 1, OTHER)], one.schema)
    where = [str(tmp_path / x) for x in ("in", "out", "state")]
    for n, df in enumerate((one, two), 1):
        df.coalesce(1).write.mode("append").parquet(where[0])
        stream_read_counts(spark, where[0], panel, 21, where[1], where[2]).awaitTermination()
        assert spark.read.parquet(where[1]).count() == n
