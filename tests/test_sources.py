import gzip
import hashlib
import io

import pytest

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.operators import provenance
from strandsieve.sources import sequences, sinks, tables


def test_fasta(spark, tmp_path, rows):
    (tmp_path / "a.fa").write_bytes(b">a first one\r\nAC\r\nGT\r\n>b\r\nTT\r\n")
    (tmp_path / "b.fa.gz").write_bytes(gzip.compress(b">c x\nGG\n"))
    got = sequences.read_fasta(spark, [str(tmp_path / "a.fa"), str(tmp_path / "b.fa.gz")], strict=True)
    assert rows(got) == [("a", "first one", "ACGT"), ("b", "", "TT"), ("c", "x", "GG")]


@pytest.mark.parametrize("text", ["AC\n>b\nGT\n", "", ">a\nAC\n>a\nGT\n", ">a\n>b\nAC\n", "> \nAC\n"])
def test_strict_fasta(spark, tmp_path, text):
    (tmp_path / "a.fa").write_text(text)
    with pytest.raises(contracts.ContractError):
        sequences.read_fasta(spark, str(tmp_path / "a.fa"), strict=True)


def test_kmer_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">a\nACG\n>b\nACT\n")
    assert sequences.read_kmer_fasta(spark, str(tmp_path / "a.fa"), 3).count() == 2
    for text in (">a\nACGT\n", ">a\nACN\n", ">a\nACG\n>b\nACG\n"):
        (tmp_path / "b.fa").write_text(text)
        with pytest.raises(contracts.ContractError):
            sequences.read_kmer_fasta(spark, str(tmp_path / "b.fa"), 3)


def test_reads_keep_their_order_and_hidden_files(spark, tmp_path, rows):
    (tmp_path / ".hidden.fastq").write_text("@x 1\nACGT\n+\nIIII\n@x 1\nTTTT\n+\nIIII\n")
    (tmp_path / "b.fq").write_bytes(gzip.compress(b"@y\nGG\n+\nII\n"))
    (tmp_path / "nested").mkdir()
    assert sequences.read_names(spark, str(tmp_path)) == [".hidden.fastq", "b.fq"]
    got = sequences.read_reads(spark, [("d", "h", f"file://{tmp_path}/.hidden.fastq"), ("d", "b", str(tmp_path / "b.fq"))])
    assert rows(got) == [("d", "b", 0, "y", "GG"), ("d", "h", 0, "x", "ACGT"), ("d", "h", 1, "x", "TTTT")]
    assert list(sequences.parse_reads(io.BytesIO(b">a b\nAC\nGT\n>c\nT\n"))) == [("a", "ACGT"), ("c", "T")]


def test_reads_are_parsed_in_pieces_of_any_size():
    import random

    rng = random.Random(1)
    records = [(f"r{i}", "".join(rng.choice("ACGTN") for _ in range(rng.randint(1, 90)))) for i in range(200)]
    fastq = "".join(f"@{n} x\n{s}\n+\n{'I' * len(s)}\n" for n, s in records).encode()
    fasta = "".join(f">{n} x\r\n{s[:40]}\r\n{s[40:]}\r\n" for n, s in records).encode()
    half = len(fastq) // 2
    for data in (fastq, fastq.rstrip(b"\n"), fastq + b"\n \n", fasta, gzip.compress(fastq), gzip.compress(fastq[:half]) + gzip.compress(fastq[half:]) + b"\0" * 9, gzip.compress(b"") + gzip.compress(fasta)):
        for size in (1, 7, 1000, 1 << 20):
            assert list(sequences.parse_reads(io.BytesIO(data), size)) == records
    assert list(sequences.parse_reads(io.BytesIO(b""))) == []
    for bad in (b"@a\nAC\n+\n", b"@a\nAC\n", b"@a\n", b"@a\nAC\n+\nI\n", b"@a\nAC\n-\nII\n", b"@a\nAC\n+\nII\nb\nAC\n+\nII\n", b"@a\nAC\n+\nII\n\n@b\nAC\n+\nII\n", b"AC\n", gzip.compress(fastq)[:-20]):
        with pytest.raises(contracts.ContractError):
            list(sequences.parse_reads(io.BytesIO(bad)))


def test_a_long_file_of_reads_comes_in_batches(spark, tmp_path):
    (tmp_path / "a.fastq.gz").write_bytes(gzip.compress(b"".join(b"@r%d\nACGTACGT\n+\nIIIIIIII\n" % i for i in range(5000))))
    got = sequences.read_reads(spark, [("d", "m", str(tmp_path / "a.fastq.gz"))], batch_bytes=10_000).collect()
    assert [(r.ordinal, r.name) for r in got] == [(i, f"r{i}") for i in range(5000)]


def test_rows_keep_their_place_in_files_that_many_tasks_read(spark, tmp_path, rows):
    from pyspark.sql import functions as F

    from strandsieve.sources.order import with_before

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        for name, n in (("a.tsv", 3000), ("b.tsv", 1), ("c.tsv", 700)):
            (tmp_path / name).write_text("x\ty\n" + "".join(f"{i}\tv{i * 7 % 10}\n" for i in range(n)))
        table = tables.read_table(spark, [str(tmp_path / n) for n in ("a.tsv", "b.tsv", "c.tsv")], "x long, y string", ordered=True)
        assert table.rdd.getNumPartitions() >= 1
        assert table.where("x <> row").count() == 0
        assert rows(table.groupBy(F.substring_index("file", "/", -1)).count()) == [("a.tsv", 3000), ("b.tsv", 1), ("c.tsv", 700)]
        before = with_before(table, ["file"], "x", chunk=64)
        assert before.where("row > 0 and (before is null or before <> x - 1)").count() == 0
        assert before.where("before is null").count() == 3
        (tmp_path / "r.fa").write_text("".join(f">s{i} d\nACGT\nAC{'GT'[i % 2]}\n" for i in range(800)))
        records = sequences.read_fasta(spark, str(tmp_path / "r.fa"), strict=True, ordered=True)
        assert records.where(F.col("id") != F.concat(F.lit("s"), F.col("row"))).count() == 0
        assert records.count() == 800
        (tmp_path / "bad.fa").write_text("".join(f">s{i}\n{'' if i in (500, 700) else 'AC'}\n" for i in range(900)))
        with pytest.raises(contracts.ContractError, match="empty record s500"):
            sequences.read_fasta(spark, str(tmp_path / "bad.fa"), strict=True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tables_have_exact_headers(spark, tmp_path, rows):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t\n2\tb\"c\n")
    assert rows(tables.read_table(spark, str(tmp_path / "a.tsv"), "x long, y string")) == [(1, ""), (2, 'b"c')]
    for text in ("x\tz\n1\ta\n", "x\ty\n1\ta\tb\n", "x\ty\n1\n"):
        (tmp_path / "b.tsv").write_text(text)
        with pytest.raises(Exception, match=r"(?s).+"):
            tables.read_table(spark, str(tmp_path / "b.tsv"), "x long, y string").collect()
    (tmp_path / "c.tsv").write_text("# note\n1\ta\n")
    assert rows(tables.read_bare_table(spark, str(tmp_path / "c.tsv"), "x long, y string")) == [(1, "a")]
    (tmp_path / "s.tsv").write_text("metric\tvalue\na\t1\nb\t\n")
    assert tables.read_status(spark, str(tmp_path / "s.tsv"), ["a", "b"]) == {"a": "1", "b": ""}
    with pytest.raises(contracts.ContractError):
        tables.read_status(spark, str(tmp_path / "s.tsv"), ["b", "a"])


def test_designs(spark, tmp_path):
    design = tables.direct_design(spark, target_taxid="88456", curated_source_sequences="in/panel.fasta.gz", background="b.fa")
    assert design.first().id == "panel"
    bad = [{"target_taxid": "0"}, {"id": "-x"}, {"background": ""}, {"query_rules": "r.tsv"}, {"curated_source_sequences": ""}, {"calibration_target_taxids": "s.tsv"}, {"calibration_reads": "a*"}, {"background": "b.txt"}]
    for change in bad:
        with pytest.raises(contracts.ContractError):
            tables.direct_design(spark, **({"id": "x", "target_taxid": "1", "curated_source_sequences": "a.fa", "background": "b.fa"} | change))
    (tmp_path / "d.csv").write_text("id,target_taxid,curated_source_sequences,background\na,1,a.fa,b.fa\nb,2,a.fa,b.fa\n")
    assert tables.read_designs(spark, str(tmp_path / "d.csv")).count() == 2
    reads = tables.direct_design(spark, id="x", target_taxid="1", curated_source_sequences="a.fa", background="b.fa", calibration_reads="reads")
    tables.check_run(reads, "reference")
    with pytest.raises(contracts.ContractError):
        tables.check_run(reads, None)


def text_of(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("d", "a", None, ""), ("d", "b", 1, 'x"y')], "design_id string, id string, n long, t string")
    sinks.write_tsv(df, str(tmp_path / "t"), ["id"])
    assert text_of(tmp_path / "t") == 'design_id\tid\tn\tt\nd\ta\t\t\nd\tb\t1\tx"y\n'
    sinks.write_tsv(df.limit(0), str(tmp_path / "e"))
    assert text_of(tmp_path / "e") == "design_id\tid\tn\tt\n"
    records = spark.createDataFrame([("a", "A" * 130), ("b", "C" * 60)], "id string, sequence string")
    sinks.write_fasta(records, str(tmp_path / "f"))
    assert text_of(tmp_path / "f") == f">a\n{'A' * 60}\n{'A' * 60}\n{'A' * 10}\n>b\n{'C' * 60}\n"
    sinks.write_fasta(records, str(tmp_path / "g"), wrap=None)
    assert text_of(tmp_path / "g") == f">a\n{'A' * 130}\n>b\n{'C' * 60}\n"
    assert sinks.write_if_any(df, str(tmp_path / "t"), lambda d, p: sinks.write_tsv(d, p))
    assert not sinks.write_if_any(df.limit(0), str(tmp_path / "t"), lambda d, p: sinks.write_tsv(d, p))
    assert not (tmp_path / "t").exists()
    assert spark.read.parquet(sinks.write_table(df, str(tmp_path), "panel", "x")).where("design_id = 'd'").count() == 2


def test_provenance(spark, tmp_path, rows):
    import base64
    import json

    (tmp_path / "in.fa").write_text(">a\nACGT\n")
    facts = provenance.file_facts(spark, [("background", "d", "file", str(tmp_path / "in.fa")), ("reads", "d", "directory", str(tmp_path))])
    assert rows(facts, "attribute", "value") == [("directory", tmp_path.name), ("filename", "in.fa"), ("sha256", hashlib.sha256(b">a\nACGT\n").hexdigest())]
    text = base64.b64encode(json.dumps([{"parameter": "k", "value": "31"}]).encode()).decode()
    assert provenance.json_rows(text, provenance.PARAMETERS, "parameters") == [("k", "31")]
    for bad in ([{"parameter": "k"}], [{"parameter": "k", "value": ""}], [{"parameter": "k", "value": "a\nb"}], {"parameter": "k"}):
        with pytest.raises(contracts.ContractError):
            provenance.json_rows(base64.b64encode(json.dumps(bad).encode()).decode(), provenance.PARAMETERS, "parameters")
    one = spark.createDataFrame([("k", "31")], "parameter string, value string")
    versions = spark.createDataFrame([("python", "3"), ("python", "3")], "component string, version string")
    assert [t.count() for t in provenance.provenance(facts, one, versions)] == [3, 1, 1]
    with pytest.raises(contracts.ContractError):
        provenance.provenance(facts, one.union(one), versions)


def test_imported_tables_report_their_first_bad_row(spark, tmp_path, rows):
    from pyspark.sql import functions as F

    from strandsieve.operators import calibrate, candidates, screening

    of = lambda df: df.withColumn("design_id", F.lit("d"))
    (tmp_path / "k.tsv").write_text("TTTTG\t3\nAAACC\t1\n")
    assert rows(candidates.imported_counts(of(tables.read_kmer_counts(spark, str(tmp_path / "k.tsv"))), 5)) == [("d", "AAACC", 1), ("d", "CAAAA", 3)]
    for text, message in (("TTTTG\t0\nAAACC\tx\nA\t1\n", "count is not positive"), ("TTTT\t1\nAANCC\t1\n", "length"), ("CAAAA\t1\nTTTTG\t1\n", "duplicate"), ("ACGTA\n", "(?s).*")):
        (tmp_path / "b.tsv").write_text(text)
        with pytest.raises(Exception, match=message):
            candidates.imported_counts(of(tables.read_kmer_counts(spark, str(tmp_path / "b.tsv"))), 5).collect()
    hit = lambda name, taxa="9", end=5, bits="80.5": [name, "s", taxa, "n", "100", "5", "0", "0", "1", str(end), "7", "11", "t"]
    members = spark.createDataFrame([("d", "bait_000001", "ACGTA"), ("d", "bait_000002", "CCGTA")], "design_id string, bait_id string, sequence string")
    (tmp_path / "h.txt").write_text("\n".join("\t".join(h) for h in (hit("bait_000002"), hit("bait_000001", "9;N/A"))) + "\n")
    checked = screening.check_hits(screening.typed_hits(of(tables.read_exact_hits(spark, str(tmp_path / "h.txt")))), members, 5)
    assert rows(checked, "qseqid", "length", "row") == [("bait_000001", 5, 1), ("bait_000002", 5, 0)]
    (tmp_path / "h.txt").write_text("\n".join("\t".join(h) for h in (hit("bait_000002", end=4), hit("bait_000001", "x"))) + "\n")
    with pytest.raises(contracts.ContractError, match="not an exact full-length match: bait_000002"):  # the first row, though a later check finds it
        screening.check_hits(screening.typed_hits(of(tables.read_exact_hits(spark, str(tmp_path / "h.txt")))), members, 5)
    head = "\t".join(S.READ_HITS) + "\n"
    line = lambda q, taxa, bits: "\t".join([q, "9", "s", taxa, "99.5", "9", "0", "0", "1", "9", "3", "11", "1e-20", bits, "100", "t"]) + "\n"
    queries = spark.createDataFrame([("d", "q")], "design_id string, representative_id string")
    (tmp_path / "r.tsv").write_text(head + line("q", "7", "80.10"))
    got = calibrate.check_read_hits(of(tables.read_read_hits(spark, str(tmp_path / "r.tsv"))), queries)
    assert rows(got, "qseqid", "evalue", "bitscore", "row") == [("q", 1e-20, "80.10", 0)]
    for text, message in ((line("q", "7", "NaN") + line("q", "7", "x"), "malformed bit score for q"), (line("p", "7", "1"), "unknown"), (line("q", "07", "1"), "malformed taxa")):
        (tmp_path / "r.tsv").write_text(head + text)
        with pytest.raises(contracts.ContractError, match=message):
            calibrate.check_read_hits(of(tables.read_read_hits(spark, str(tmp_path / "r.tsv"))), queries)
    (tmp_path / "r.tsv").write_text(head)
    assert tables.read_read_hits(spark, str(tmp_path / "r.tsv")).count() == 0
