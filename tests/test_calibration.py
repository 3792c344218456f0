import pytest

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.operators import align, calibrate, reads

READ_HITS = "design_id string, qseqid string, qlen long, saccver string, staxids string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore string, qcovhsp double, stitle string"


def hit(query, taxids, score, subject="s"):
    return ("d", query, 100, subject, taxids, 99.0, 100, 1, 0, 1, 100, 1, 100, 1e-20, score, 100.0, "t")


def classified(spark, hits, queries=("q",), scope=("88456",)):
    counts = spark.createDataFrame([("d", "m", f"read_{i:012d}", 100, 1, q) for i, q in enumerate(queries)], "design_id string, metagenome_id string, read_id string, read_length long, bait_count long, representative_id string")
    scopes = spark.createDataFrame([("d", list(scope))], "design_id string, scope array<string>")
    frame = spark.createDataFrame(hits, READ_HITS)
    return {r.representative_id: (r.classification, r.best_target_bit_score, r.best_non_target_bit_score) for r in calibrate.classify_reads(counts, calibrate.representative_scores(calibrate.hit_scope(frame, scopes))).collect()}


def test_classes(spark):
    got = classified(spark, [hit("t", "88456", "50"), hit("o", "9", "50.0"), hit("m", "88456;9", "50"), hit("u", "N/A", "50")], ("t", "o", "m", "u", "n"))
    assert got == {"t": (S.TARGET, "50", ""), "o": (S.NON_TARGET, "", "50"), "m": (S.TIED, "50", "50"), "u": (S.NON_TARGET, "", "50"), "n": (S.NO_HIT, "", "")}


@pytest.mark.parametrize(("target", "want"), [("100.1", S.TIED), ("100.1001", S.TARGET), ("99.9", S.TIED), ("99.8999", S.NON_TARGET)])
def test_ties_are_exact_in_decimals(spark, target, want):
    assert classified(spark, [hit("q", "88456", target), hit("q", "9", "100")])["q"][0] == want


@pytest.mark.parametrize("bad", [hit("q", "88456;", "1"), hit("q", "0", "1"), hit("q", "-1", "1"), hit("q", "088456", "1"), hit("z", "1", "1"), hit("q", "1", "NaN"), hit("q", "1", "x"), hit("q", None, "1")])
def test_hits_are_checked(spark, bad):
    queries = spark.createDataFrame([("d", "q")], "design_id string, representative_id string")
    calibrate.check_read_hits(spark.createDataFrame([hit("q", "1, 2;N", "1")[:4] + ("1, 2",) + hit("q", "", "1")[5:]], READ_HITS), queries)
    with pytest.raises(contracts.ContractError):
        calibrate.check_read_hits(spark.createDataFrame([bad], READ_HITS), queries)


def curve(spark, pairs, designs=None):
    df = spark.createDataFrame([("d", n, c) for n, c in pairs], "design_id string, bait_count long, classification string")
    return calibrate.threshold_curve(df, designs)


def test_curve_and_recommendation(spark, rows):
    pairs = [(3, S.TARGET), (1, S.TARGET), (1, S.TARGET), (1, S.TARGET), (1, S.NON_TARGET), (1, S.NON_TARGET), (2, S.TIED), (2, S.NO_HIT)]
    pairs[1:4] = [(2, S.TARGET)] * 3
    got = curve(spark, pairs)
    assert rows(got, *S.THRESHOLD_COUNTS) == [(1, 4, 2, 1, 1), (2, 4, 0, 1, 1), (3, 1, 0, 0, 0), (4, 0, 0, 0, 0)]
    assert rows(got) == rows(curve(spark, pairs[::-1]))
    assert rows(calibrate.recommended_threshold(got)) == [("d", 3, S.RECOMMENDED)]


def test_no_threshold_and_no_reads(spark, rows):
    assert rows(calibrate.recommended_threshold(curve(spark, [(2, S.TARGET), (3, S.NON_TARGET)]))) == [("d", None, S.UNSUPPORTED)]
    designs = spark.createDataFrame([("d",)], "design_id string")
    empty = curve(spark, [], designs)
    assert rows(empty, *S.THRESHOLD_COUNTS) == [(1, 0, 0, 0, 0)]
    preparation = spark.createDataFrame([("d", 0, 0, 0, 0)], ", ".join(f"{c} {'string' if c == 'design_id' else 'long'}" for c in S.PREPARATION))
    summary = {r.metric: r.value for r in calibrate.threshold_summary(empty, preparation).collect()}
    assert len(summary) == 12
    assert summary["calibration_status"] == S.NO_CANDIDATE_READS


def test_scope(spark, rows):
    targets = spark.createDataFrame([("d", "5")], "design_id string, target_taxid string")
    scope = lambda *t: spark.createDataFrame([("d", x) for x in t], "design_id string, taxid string")
    assert rows(calibrate.calibration_scope(targets)) == [("d", ["5"])]
    assert rows(calibrate.calibration_scope(targets, scope("7", "5"))) == [("d", ["5", "7"])]
    for bad in (("7",), ("5", "05"), ("5", "5")):
        with pytest.raises(contracts.ContractError):
            calibrate.calibration_scope(targets, scope(*bad))


def test_read_counts_identities_and_duplicates(spark, rows):
    panel = spark.createDataFrame([("d", "bait_000001", "ACGTA")], "design_id string, bait_id string, sequence string")
    given = [("d", "m", i, s) for i, s in enumerate(("ACGTA", "GGGGG", "TACGT", "acgta", "ACGTACGTA"))]
    frame = spark.createDataFrame(given, "design_id string, metagenome_id string, ordinal long, sequence string")
    counted = reads.count_panel_kmers(frame, panel, 5).persist()
    got = counted.orderBy("read_id").collect()
    assert [(r.read_id, r.bait_count, r.read_length) for r in got] == [("read_000000000001", 1, 5), ("read_000000000002", 1, 5), ("read_000000000003", 1, 5), ("read_000000000004", 1, 9)]
    assert len({r.representative_id for r in got[:3]}) == 1
    assert reads.read_queries(counted).count() == 2
    returned = spark.createDataFrame([("d", 4)], "design_id string, returned long")
    assert rows(reads.preparation_summary(counted, returned, panel)) == [("d", 4, 4, 2, 2)]
    reads.check_counts(counted.select("design_id", *S.READ_COUNTS))


def test_names_of_read_sources(spark, rows):
    names = ["sample.fastq", "sample.fastq.gz", "other.fq", "a b;c.fastq", "notes.txt", ".hidden.fq"]
    got = reads.resolve_read_sources(spark.createDataFrame([("d", n) for n in names], "design_id string, name string"))
    by = {r.read: r.metagenome_id for r in got.collect()}
    assert (by["sample.fastq"], by["sample.fastq.gz"], by["other.fq"]) == ("sample.fastq", "sample.fastq.gz", "other")
    assert by["a b;c.fastq"].startswith("read_")
    assert by[".hidden.fq"].startswith("read_")
    assert "notes.txt" not in by
    assert {r.id for r in got.collect()} >= {"d__other"}


def test_subject_limit(spark):
    hits = spark.createDataFrame([hit("q", "1", "50", f"s{i:03d}") for i in range(101)] + [hit("q", "1", "60", "s100")], READ_HITS)
    kept = align.keep_best_subjects(hits, 100)
    assert kept.select("saccver").distinct().count() == 100
    assert kept.where("saccver = 's100'").count() == 2


def test_shards(spark):
    queries = spark.range(100).selectExpr("'d' AS design_id", "cast(id AS string) AS representative_id")
    assert {r.shard for r in reads.shard_queries(queries, 4).collect()} == {0, 1, 2, 3}
    one = spark.createDataFrame([hit("q", "1", "50")], READ_HITS)
    both, parameters = reads.gather_shards([one, one], [{"max_target_seqs": "100"}] * 2)
    assert both.count() == 2
    assert parameters == {"max_target_seqs": "100", "query_file_count": "2"}
    with pytest.raises(contracts.ContractError):
        reads.gather_shards([one, one.drop("qlen")], [{}, {}])


def _sources(spark, change=None):
    """Count files of three sources, one without rows, with their statuses and queries."""
    rep = lambda c: f"sequence_{c * 64}"
    rows = [["d", "b", 0, "mb", "read_000000000001", "90", "2", rep("a")], ["d", "a", 0, "ma", "read_000000000001", "100", "3", rep("b")], ["d", "a", 1, "ma", "read_000000000002", "80", "1", rep("a")]]
    status = {("d", "a"): ["ma", "2", "2"], ("d", "b"): ["mb", "1", "1"], ("d", "c"): ["mc", "0", "0"]}
    sources, queries = [("d", "a"), ("d", "b"), ("d", "c")], [("d", rep("a")), ("d", rep("b"))]
    if change:
        change(rows, status, sources, queries)
    put = spark.createDataFrame
    long = [(*k, i, m, v) for k, values in status.items() for i, (m, v) in enumerate(zip(reads.READ_STATUS, values))]
    return (
        put([tuple(r) for r in rows], "design_id string, source string, row long, metagenome_id string, read_id string, read_length string, bait_count string, representative_id string"), put(sources, "design_id string, source string"),
        put(long, "design_id string, source string, ordinal int, metric string, value string"), put(queries, "design_id string, representative_id string"),
    )


def combined(spark, change=None):
    counts, sources, status, queries = _sources(spark, change)
    return reads.combine_counts(counts, sources, reads.read_statuses(status), queries)


def test_counts_of_sources_are_combined_in_order_of_names(spark, rows):
    table, summary = combined(spark)
    assert [(r.ordinal, r.metagenome_id, r.read_id, r.bait_count) for r in table.orderBy("ordinal").collect()] == [(1, "ma", "read_000000000001", 3), (2, "ma", "read_000000000002", 1), (3, "mb", "read_000000000001", 2)]
    assert rows(summary) == [("d", 3, 3, 1, 2)]


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda r, st, so, q: st.pop(("d", "c")), "no status"), (lambda r, st, so, q: so.pop(), "no counts"), (lambda r, st, so, q: st.update({("d", "c"): ["mc", "1", "0"]}), "disagree in c"), (lambda r, st, so, q: st.update({("d", "c"): ["ma", "0", "0"]}), "duplicate"),
        (lambda r, st, so, q: st.update({("d", "c"): ["mc", "-1", "0"]}), "malformed status of c"), (lambda r, st, so, q: st.update({("d", "c"): ["mc", "0"]}), "malformed status of c"), (lambda r, st, so, q: st.update({("d", "a"): ["ma", "3", "3"]}), "rows and status disagree in a"),
        (lambda r, st, so, q: r[1].__setitem__(3, "mb"), "malformed row of a"), (lambda r, st, so, q: r[2].__setitem__(4, "read_000000000001"), "malformed row of a"), (lambda r, st, so, q: r[0].__setitem__(6, "0"), "malformed row of b"),
        (lambda r, st, so, q: r[0].__setitem__(7, "sequence_x"), "malformed row of b"), (lambda r, st, so, q: q.pop(), "missing"), (lambda r, st, so, q: q.append(("d", "sequence_" + "c" * 64)), "without a read"),
    ],
)
def test_every_disagreement_of_sources_is_an_error(spark, change, message):
    with pytest.raises(contracts.ContractError, match=message):
        combined(spark, change)
