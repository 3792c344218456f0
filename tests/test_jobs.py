from __future__ import annotations

import logging
import random

import pytest
from pyspark.sql import functions as F

from jobs import refresh_panels as refresh
from jobs import screen_reads as screen
from jobs.common import settings
from strandsieve.functions.sequence import canonical

K = 9


def text(rng, n):
    return "".join(rng.choice("abcd") for _ in range(n))


@pytest.fixture
def lab(spark, tmp_path):
    """Sources, background, reference and reads as small tables on disk."""
    rng = random.Random(9)
    genes = [text(rng, 60) for _ in range(6)]
    put = lambda rows, ddl, name: spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    put(list(enumerate(genes)), "item_id long, text string", "benchmark")
    put([(i, 0, "user", genes[i][:20] + text(rng, 30)) for i in range(3)], "conv_id long, turn int, role string, text string", "conversations")
    read = lambda i: (i, None if i == 7 else "" if i == 8 else text(rng, 20) + genes[i % 6][10:50] + text(rng, 20) if i % 2 else text(rng, 70), "en", "web")
    docs = "doc_id long, text string, lang string, source string"
    put([read(i) for i in range(40)], docs, "documents")

    class Lab:
        path = str(tmp_path)

        def arrive(self, numbers, name="documents"):
            put([read(i) for i in numbers], docs, name)

        def add(self, name, rows, ddl):
            put(rows, ddl, name)

        def refresh(self, out="panels", **more):
            return refresh.refresh_panels(spark, f"{tmp_path}/benchmark", f"{tmp_path}/conversations", f"{tmp_path}/documents", f"{tmp_path}/{out}", kmer_size=K, **more)

        def panel(self):
            spark.createDataFrame([(f"d{i % 3}", genes[i][10:50]) for i in range(6)], "design_id string, gene string").select(
                "design_id", F.explode(F.regexp_extract_all(F.translate("gene", "abcd", "ACGT"), F.lit(f"(?=(.{{{K}}}))"), F.lit(1))).alias("w")
            ).select("design_id", canonical(F.col("w")).alias("sequence")).distinct().write.mode("overwrite").parquet(f"{tmp_path}/panel")

        def screen(self, out="screened", **more):
            return screen.screen_reads(spark, f"{tmp_path}/documents", f"{tmp_path}/panel", f"{tmp_path}/{out}", f"{tmp_path}/{out}-progress", kmer_size=K, **more)

    return Lab()


def brute_screen(spark, lab, rows):
    """Matching reads by plain loops over the whole tables."""
    members: dict[str, set[str]] = {}
    for r in spark.read.parquet(f"{lab.path}/panel").collect():
        members.setdefault(r.design_id, set()).add(r.sequence)
    out = []
    for r in spark.read.parquet(f"{lab.path}/documents").collect():
        s = "".join(("ACGT" * 7)[ord(c) - 97] for c in r.text or "")
        both = {w: min(w, w[::-1].translate(str.maketrans("ACGT", "TGCA"))) for w in (s[i : i + K] for i in range(len(s) - K + 1))}
        n = len(set(both.values()) & members.get(f"d{r.doc_id % 3}", set()))
        if n:
            out.append((f"d{r.doc_id % 3}", f"m{r.doc_id % 2}", r.doc_id, len(s), n))
    return sorted(out, key=repr)


COLUMNS = ("design_id", "metagenome_id", "ordinal", "read_length", "bait_count")


def test_screening_takes_only_what_is_new(spark, lab, rows, caplog):
    lab.panel()
    settings_before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with caplog.at_level(logging.INFO):
        first = lab.screen()
        assert first.read == 40
        lab.arrive(range(100, 120))
        lab.arrive(range(200, 205))
        second = lab.screen()
        third = lab.screen()
    assert (second.read, third.read, third.batches) == (25, 0, [])
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == settings_before
    assert "25 reads read" in caplog.text
    want = brute_screen(spark, lab, rows)
    assert len(want) > 25
    assert rows(screen.screened(spark, f"{lab.path}/screened"), *COLUMNS) == want
    # The same from nothing, and a file at a time.
    lab.screen("again", batch_files=1)
    assert rows(screen.screened(spark, f"{lab.path}/again"), *COLUMNS) == want
    seen = spark.read.schema(screen.SEEN).parquet(f"{lab.path}/again/seen").agg(F.sum("reads"), F.sum("matching_reads")).first()
    assert tuple(seen) == (65, len(want))


def test_a_batch_that_failed_is_done_again(spark, lab, rows, monkeypatch):
    lab.panel()
    whole = screen._write

    def failing(df, path):
        whole(df, path)
        if path.endswith("seen"):
            raise RuntimeError("lost")

    monkeypatch.setattr(screen, "_write", failing)
    with pytest.raises(Exception, match="lost"):
        lab.screen()
    monkeypatch.setattr(screen, "_write", whole)
    lab.arrive(range(300, 310))
    lab.screen()
    assert rows(screen.screened(spark, f"{lab.path}/screened"), *COLUMNS) == brute_screen(spark, lab, rows)


def test_screening_without_reads_or_panel(spark, lab, tmp_path):
    assert screen.screened(spark, f"{tmp_path}/nothing").count() == 0
    spark.createDataFrame([], "design_id string, sequence string").write.parquet(f"{tmp_path}/panel")
    report = lab.screen()
    assert (report.read, report.matching) == (40, 0)
    assert screen.screened(spark, f"{tmp_path}/screened").count() == 0


def test_only_changed_designs_are_made(spark, lab, rows, caplog):
    with caplog.at_level(logging.INFO):
        first = lab.refresh()
        again = lab.refresh()
    assert (first.made, again.made, again.kept) == (["d0", "d1", "d2"], [], 3)
    assert "designs: 0 to make, 3 as they were" in caplog.text
    assert "read 6 source sequences, 3 background sequences and 40 reference records" in caplog.text
    rng = random.Random(1)
    lab.add("benchmark", [(9, text(rng, 50))], "item_id long, text string")
    lab.add("conversations", [(4, 0, "user", text(rng, 80))], "conv_id long, turn int, role string, text string")
    before = rows(refresh.current(spark, f"{lab.path}/panels").where("design_id = 'd2'"))
    assert lab.refresh().made == ["d0", "d1"]  # 9 and 4
    lab.refresh("fresh")
    for name in ("manifest", "status"):
        assert rows(refresh.current(spark, f"{lab.path}/panels", name)) == rows(refresh.current(spark, f"{lab.path}/fresh", name))
    assert rows(refresh.current(spark, f"{lab.path}/panels").where("design_id = 'd2'")) == before
    assert refresh.panel(spark, f"{lab.path}/panels").count() > 0
    assert lab.refresh(entropy_threshold=0.5).made == ["d0", "d1", "d2"]  # a parameter is an input
    lab.arrive([500])
    assert lab.refresh(entropy_threshold=0.5).made == ["d0", "d1", "d2"]  # so is the shared reference


def test_a_refresh_that_failed_leaves_the_results_before(spark, lab, rows, monkeypatch):
    lab.refresh()
    old = rows(refresh.current(spark, f"{lab.path}/panels"))
    lab.add("benchmark", [(12, text(random.Random(2), 50))], "item_id long, text string")
    whole = refresh._write

    def failing(df, path, *partitions):
        if path.endswith("marks"):
            raise RuntimeError("lost")
        whole(df, path, *partitions)

    monkeypatch.setattr(refresh, "_write", failing)
    with pytest.raises(RuntimeError):
        lab.refresh()
    assert rows(refresh.current(spark, f"{lab.path}/panels")) == old
    monkeypatch.setattr(refresh, "_write", whole)
    assert lab.refresh().made == ["d0"]
    lab.refresh("fresh")
    assert rows(refresh.current(spark, f"{lab.path}/panels")) == rows(refresh.current(spark, f"{lab.path}/fresh"))


def test_a_design_without_sources_has_no_results(spark, lab, tmp_path):
    lab.refresh()
    spark.read.parquet(f"{lab.path}/benchmark").where("item_id % 3 != 1").write.parquet(f"{tmp_path}/fewer")
    report = refresh.refresh_panels(spark, f"{tmp_path}/fewer", f"{lab.path}/conversations", f"{lab.path}/documents", f"{lab.path}/panels", kmer_size=K)
    assert (report.made, report.kept, report.retired) == ([], 2, ["d1"])
    assert {r.design_id for r in refresh.current(spark, f"{lab.path}/panels", "status").collect()} == {"d0", "d2"}
    assert refresh.current(spark, f"{tmp_path}/nothing").count() == 0


def test_settings_come_from_the_file_and_the_command_line(tmp_path):
    for known, name in ((screen.SETTINGS, "screen_reads.toml"), (refresh.SETTINGS, "refresh_panels.toml")):
        assert set(settings([], name, known)) == set(known)
    assert settings(["--output", "x", "--kmer-size", "21"], "refresh_panels.toml", refresh.SETTINGS) | {"output": "x"} == settings(["--output=x", "--kmer-size=21"], "refresh_panels.toml", refresh.SETTINGS)
    config = tmp_path / "c.toml"
    config.write_text('reads = "a"\nother = 1\n')
    for bad in (["--config", str(config)], ["--kmer-size", "x"]):
        with pytest.raises(SystemExit):
            settings(bad, "screen_reads.toml", screen.SETTINGS)
