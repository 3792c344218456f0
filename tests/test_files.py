from __future__ import annotations

import gzip
import hashlib
import random

import pytest

from strandsieve import contracts
from strandsieve.functions.ranking import numbered_by
from strandsieve.plans.design import Parameters
from strandsieve.plans.files import run_files

from .test_design import OTHER, SOURCE, turned


def text_of(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


@pytest.fixture
def lab(spark, tmp_path):
    """Files of two designs, one curated and with reads, one discovered; they share a background."""
    put = lambda name, text: (tmp_path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    put("curated.fa.gz", gzip.compress(f">s one\n{SOURCE[:30]}\n{SOURCE[30:]}\n".encode()))
    put("background.fasta", f">x\n{SOURCE[:25]}\n>y\n{'A' * 40}\n")
    put("queries.fa", f">q\n{OTHER}\n")
    put("rules.tsv", "query_id\tquery_group\tquery_start\tquery_end\tmin_identity\tmin_query_coverage\nq\tg\t1\t0\t90\t90\n")
    put("assembly.fna", f">asm\nGG{turned(OTHER)}CC\n")
    (tmp_path / "reads").mkdir()
    put("reads/m.fastq", "".join(f"@r\n{s}\n+\n{'I' * len(s)}\n" for s in (SOURCE, turned(SOURCE), "G" * 50)))
    put("reads/notes.txt", "no reads")
    head = "id,target_taxid,curated_source_sequences,representative_queries,query_rules,target_assembly,background,calibration_reads\n"
    p = str(tmp_path)
    put("designs.csv", f"{head}a,1,{p}/curated.fa.gz,,,,{p}/background.fasta,{p}/reads\nb,1,,{p}/queries.fa,{p}/rules.tsv,{p}/assembly.fna,{p}/background.fasta,\n")
    rows = [("r1", "1", "n", "t", SOURCE), ("r2", "2", "n", "t", "CC" + SOURCE[27:48]), ("r3", "1", "n", "t", OTHER)]
    spark.createDataFrame(rows, "saccver string, staxids string, sscinames string, stitle string, sequence string").write.parquet(f"{p}/reference")
    return tmp_path


def test_from_a_design_table_to_published_tables(spark, lab):
    p = Parameters(kmer_size=21, entropy_threshold=0.5)
    run = run_files(spark, f"{lab}/designs.csv", f"{lab}/out", f"{lab}/reference", p)
    out = lab / "out"
    lines = text_of(out / "03_taxonomic_screening/a/manifest").splitlines()
    assert lines[0].split("\t")[:4] == ["design_id", "candidate_kmer_id", "bait_id", "kmer"]
    assert len(lines) == len(SOURCE) - 20 + 1
    assert sum("REJECT_INTERFERENCE_BACKGROUND" in x for x in lines) == 5
    assert sum("REJECT_OFF_TARGET_HIT" in x for x in lines) == 1
    assert not (out / "02_candidate_kmers/manifest").exists()  # published once
    assert text_of(out / "01_source_sequences/b/loci").count("asm") == 1
    assert text_of(out / "01_source_sequences/a/loci").count("\n") == 1  # its header alone
    assert text_of(out / "06_calibration/b/read_counts") == "design_id\tmetagenome_id\tread_id\tread_length\tbait_count\trepresentative_id\n"
    assert text_of(out / "06_calibration/a/classified_reads").count("TARGET") == 2
    inputs = text_of(out / "07_provenance/inputs").splitlines()
    digest = hashlib.sha256((lab / "background.fasta").read_bytes()).hexdigest()
    assert [x for x in inputs if x.startswith("background\ta\t")] == ["background\ta\tfilename\tbackground.fasta", f"background\ta\tsha256\t{digest}"]
    assert inputs[1:] == sorted(inputs[1:])
    assert "calibration_reads\ta\tdirectory\treads" in inputs
    assert text_of(out / "07_provenance/parameters").startswith("parameter\tvalue\nentropy_threshold\t0.5\nkmer_size\t21\n")
    assert [x.split("\t")[0] for x in text_of(out / "07_provenance/versions").splitlines()] == ["component", "numpy", "python", "spark"]
    assert "# Index verification: a" in text_of(out / "05_index/report")
    before = {str(f.relative_to(out)): text_of(f.parent) for f in out.rglob("part-*.csv")}
    run_files(spark, f"{lab}/designs.csv", f"{lab}/out", f"{lab}/reference", p)  # again: the same
    after = {str(f.relative_to(out)): text_of(f.parent) for f in out.rglob("part-*.csv")}
    assert sorted(before.values()) == sorted(after.values())
    assert "calibration" in run.steps


@pytest.mark.parametrize(
    ("name", "text", "message"),
    [("rules.tsv", "query_id\tquery_group\tquery_start\tquery_end\tmin_identity\tmin_query_coverage\nq\tg\t9\t2\t90\t90\n", "invalid interval"), ("queries.fa", f">q\n{OTHER}\n>e\n>f\nAC\n", "empty record e"), ("reads/m.fastq", "@r\nACGT\n+\nII\n", "malformed FASTQ"), ("curated.fa.gz", gzip.compress(b">s\nACGT\n>s\nAC\n"), "duplicate")],
)
def test_bad_files_are_errors(spark, lab, name, text, message):
    (lab / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    with pytest.raises(Exception, match=message):
        run_files(spark, f"{lab}/designs.csv", f"{lab}/out", f"{lab}/reference", Parameters(kmer_size=21))


@pytest.mark.parametrize("bad", [{"kmer_size": 0}, {"entropy_threshold": 1.5}, {"max_subjects": 0}, {"tie_tolerance": "-1"}])
def test_parameters_are_checked(bad):
    with pytest.raises(contracts.ContractError):
        Parameters(**bad)


def test_numbers_by_any_columns(spark, rows):
    rng = random.Random(3)
    given = [(rng.choice("abc") if i % 9 else None, rng.randint(0, 40), rng.choice(["x", "y", None]), i) for i in range(500)]
    got = numbered_by(spark.createDataFrame(given, "k string, n int, s string, i int").repartition(5), ["k"], ["n", "s", "i"], "at")
    want = []
    for k in {g[0] for g in given}:
        own = sorted((g for g in given if g[0] == k), key=lambda g: (g[1], g[2] is not None, g[2] or "", g[3]))
        want += [(*g, n) for n, g in enumerate(own, 1)]
    assert rows(got) == sorted(want, key=repr)
    assert numbered_by(spark.createDataFrame([], "k string, n int"), ["k"], ["n"], "at").count() == 0
