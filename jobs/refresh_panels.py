"""Keeps the screened panels of many designs up to date: only designs whose inputs have changed are made anew.

    python jobs/refresh_panels.py --config jobs/refresh_panels.toml [--output PATH ...]

Inputs are source sequences (the benchmark table), interference background (conversations) and the shared taxonomic
reference (documents). A design's mark is a digest of all its inputs and parameters: number, sum and exclusive or of the
hashes of its rows, so the order of rows and files does not matter. Where the mark differs from the one of the last run, the
design is made from its sources to its screened manifest. Tables in `output`:

- `manifest`: the screened manifest, partitioned by design_id and mark;
- `status`: metrics of each design, partitioned alike;
- `marks`: design_id and the mark of its latest results, written last.

Results lie under the mark of the inputs they were made from, so what a run that failed left is replaced by the next run, and
until the mark is written readers see the results before. A design that no longer has sources gets an empty mark, and so no
results. A run without changes writes nothing. Results under earlier marks stay on disk, where no reader of `current` sees them.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, prepared, session, settings, table_or_none
from strandsieve import schema as S
from strandsieve.operators import candidates, screening
from strandsieve.plans import suite
from strandsieve.session import settled

SETTINGS = {"sources": str, "background": str, "reference": str, "output": str, "target_taxid": str, "kmer_size": int, "entropy_threshold": float}
MARKS = "mark string, design_id string"
STATUS = "ordinal int, metric string, value string, design_id string, mark string"
MANIFEST = ", ".join(f"{c} {'long' if c in ('source_copy_count', 'background_occurrences', 'on_target_hits', 'off_target_hits') else 'string'}" for c in S.MANIFEST) + ", design_id string, mark string"


@dataclass
class Report:
    """Designs that were made, left as they were, and given up."""

    made: list[str] = field(default_factory=list)
    kept: int = 0
    retired: list[str] = field(default_factory=list)


def _digest(rows: DataFrame, *keys: str) -> DataFrame:
    """keys and `digest` of a set of rows in any order, repeats counted."""
    h = F.xxhash64(*rows.columns)
    parts = (F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h))
    return rows.groupBy(*keys).agg(F.concat_ws("/", *[p.cast("string") for p in parts]).alias("digest"), parts[0].alias("n"))


def marks_of(sources: DataFrame, background: DataFrame, reference: DataFrame, parameters: dict[str, object]) -> DataFrame:
    """design_id, mark, and rows read of sources, background and reference, of each design that has sources."""
    shared = _digest(reference).first()  # one row
    fixed: list[Column] = [F.lit(shared.digest), *[F.lit(f"{k}={v}") for k, v in sorted(parameters.items())]]
    behind = _digest(background, "design_id").select("design_id", F.col("digest").alias("background"), F.col("n").alias("n_background"))
    both = _digest(sources, "design_id").join(behind, "design_id", "left")
    mark = F.sha2(F.concat_ws("|", "digest", F.coalesce("background", F.lit("")), *fixed), 256)
    return both.select("design_id", mark.alias("mark"), F.col("n").alias("n_sources"), F.coalesce("n_background", F.lit(0)).alias("n_background"), F.lit(shared.n).alias("n_reference"))


def refresh_panels(spark: SparkSession, sources: str, background: str, reference: str, output: str, target_taxid: str = "1", kmer_size: int = 15, entropy_threshold: float = 0.9) -> Report:
    """Brings the tables in `output` up to date with the inputs."""
    with prepared(spark):
        return _refresh(spark, sources, background, reference, output, target_taxid, kmer_size, entropy_threshold)


def _refresh(spark: SparkSession, sources: str, background: str, reference: str, output: str, target_taxid: str, kmer_size: int, entropy_threshold: float) -> Report:
    made_of, behind, shared = suite.sources_of(spark.read.parquet(sources)), suite.background_of(spark.read.parquet(background)), suite.reference_of(spark.read.parquet(reference))
    now = settled(marks_of(made_of, behind, shared, {"taxid": target_taxid, "k": kmer_size, "entropy": entropy_threshold}))
    read = now.agg(F.sum("n_sources"), F.sum("n_background"), F.max("n_reference")).first()
    log.info("read %d source sequences, %d background sequences and %d reference records", *(n or 0 for n in read))
    now = now.select("design_id", "mark")
    before = table_or_none(spark, f"{output}/marks", MARKS)
    before = settled((before if before is not None else spark.createDataFrame([], MARKS)).select("design_id", "mark"))
    changed = settled(now.join(before, ["design_id", "mark"], "left_anti"))
    retired = settled(before.where("mark <> ''").join(now, "design_id", "left_anti").select("design_id", F.lit("").alias("mark")))
    # A name for each design, and designs are few beside their rows.
    report = Report([r.design_id for r in changed.select("design_id").orderBy("design_id").toLocalIterator()], retired=[r.design_id for r in retired.orderBy("design_id").toLocalIterator()])
    report.kept = now.count() - len(report.made)
    log.info("designs: %d to make, %d as they were, %d without sources", len(report.made), report.kept, len(report.retired))
    if report.made:
        mine = lambda df: df.join(changed.select("design_id"), "design_id", "left_semi")
        manifest, status = _screened(mine(made_of), mine(behind), shared, changed, target_taxid, kmer_size, entropy_threshold)
        for name, df in (("manifest", manifest), ("status", status)):
            _write(df.join(changed, "design_id"), f"{output}/{name}", "design_id", "mark")
            rows = spark.read.parquet(f"{output}/{name}").join(changed, ["design_id", "mark"], "left_semi").count()
            log.info("wrote %d rows to %s/%s", rows, output, name)
    if report.made or report.retired:
        _write(changed.unionByName(retired), f"{output}/marks", "design_id")
    return report


def _screened(sources: DataFrame, background: DataFrame, reference: DataFrame, designs: DataFrame, taxid: str, k: int, entropy: float) -> tuple[DataFrame, DataFrame]:
    """Manifest after screening, and status metrics, of the designs that are made."""
    targets = designs.select("design_id", F.lit(taxid).alias("target_taxid"), F.lit(S.CURATED).alias("source_sequence_origin"))
    counts = settled(candidates.kmer_counts(candidates.enumerate_kmers(sources, k)))
    before = settled(candidates.build_manifest(counts, settled(candidates.background_counts(counts, background, k))))
    manifest = settled(candidates.filter_complexity(before, entropy))
    local = candidates.panel_of(manifest)
    decisions = settled(screening.screening_decisions(local, settled(screening.exact_match_hits(local, reference, k)), targets))
    screened = settled(screening.apply_screening(manifest, decisions))
    return screened, screening.set_status(screened, targets, screened=True)


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def current(spark: SparkSession, output: str, name: str = "manifest") -> DataFrame:
    """The latest rows of `manifest` or `status`: those under the marks."""
    schema = MANIFEST if name == "manifest" else STATUS
    rows, marks = table_or_none(spark, f"{output}/{name}", schema), table_or_none(spark, f"{output}/marks", MARKS)
    if rows is None or marks is None:
        rows = marks = spark.createDataFrame([], schema)
    latest = rows.join(F.broadcast(marks.select("design_id", "mark")), ["design_id", "mark"], "left_semi")
    return latest.select("design_id", *(S.MANIFEST if name == "manifest" else ("ordinal", "metric", "value")))


def panel(spark: SparkSession, output: str) -> DataFrame:
    """design_id, bait_id and sequence of the panels as they stand."""
    return candidates.panel_of(current(spark, output))


def main(argv: list[str] | None = None) -> None:
    values = settings(argv, "refresh_panels.toml", SETTINGS)
    spark = session("refresh-panels")
    try:
        refresh_panels(spark, **values)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
