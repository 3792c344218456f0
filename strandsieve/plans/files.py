"""From a design table of file paths to published tables: every design's files are read, run together, and written by stage."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve.operators import provenance
from strandsieve.operators.discovery import check_rules
from strandsieve.operators.panel import report
from strandsieve.operators.reads import resolve_read_sources
from strandsieve.plans.design import STAGE_OF, Inputs, Parameters, Run, run_designs
from strandsieve.session import settled, small
from strandsieve.sources import sequences, sinks, tables

RULES = "query_id string, query_group string, query_start long, query_end long, min_identity double, min_query_coverage double"
_FILES = {
    "curated_source_sequences": "source sequences", "representative_queries": "representative queries", "query_rules": "query rules", "target_assembly": "target assembly",
    "background": "background", "calibration_target_taxids": "calibration scope",
}


def _path(column: str) -> F.Column:
    """A path as Spark reports it and one as it was given, in one form."""
    return F.regexp_replace(F.regexp_replace(column, "^file:/+", "/"), "/+$", "")


def _of_designs(rows: DataFrame, designs: DataFrame, column: str) -> DataFrame:
    """Rows with their `file`, once for each design that names it: a shared file is read once."""
    named = designs.where(~contracts.blank(column)).select(F.col("id").alias("design_id"), _path(column).alias("_file"))
    return rows.withColumn("_file", _path("file")).join(small(settled(named)), "_file").drop("_file", "file")


def _paths(designs: DataFrame, column: str) -> list[str]:
    """Distinct files of a column; as many as there are designs at most."""
    return [r[0] for r in designs.where(~contracts.blank(column)).select(column).distinct().orderBy(column).toLocalIterator()]


def read_inputs(spark: SparkSession, designs: DataFrame, reference: DataFrame | None = None) -> Inputs:
    """Tables of all designs (as `tables.read_designs` gives them) from their files."""
    tables.check_run(designs, None if reference is None else "reference")

    def fasta(column: str, name: str, strict: bool = True) -> DataFrame | None:
        paths = _paths(designs, column)
        if not paths:
            return None
        records = sequences.read_fasta(spark, paths, ordered=True)
        if strict:
            checks = [((F.col("row") == 0) & (F.col("id") == ""), "text before the first record"), (F.col("id") == "", "record without id"), (F.col("sequence") == "", F.concat(F.lit("empty record "), F.col("id")))]
            contracts.require(records, checks, ["file", "row"], _FILES[column])
            contracts.require_unique(records, ["file", "id"], _FILES[column])
        return settled(_of_designs(records, designs, column).select("design_id", F.col("id").alias(name), "sequence"))

    def table(column: str, ddl: str) -> DataFrame | None:
        paths = _paths(designs, column)
        return settled(_of_designs(tables.read_table(spark, paths, ddl, ordered=True), designs, column)) if paths else None

    rules = table("query_rules", RULES)
    if rules is not None:
        check_rules(rules)
        rules = rules.drop("row")
    scope = table("calibration_target_taxids", "taxid string")
    reads = None
    with_reads = designs.where(~contracts.blank("calibration_reads")).select("id", "calibration_reads").collect()  # a row for each design
    if with_reads:
        listed = [(r.id, name) for r in with_reads for name in sequences.read_names(spark, r.calibration_reads)]
        named = resolve_read_sources(spark.createDataFrame(listed, "design_id string, name string"))
        folder = {r.id: r.calibration_reads.rstrip("/") for r in with_reads}
        files = [(r.design_id, r.metagenome_id, f"{folder[r.design_id]}/{r.read}") for r in named.toLocalIterator()]
        for r in with_reads:
            if not any(f[0] == r.id for f in files):
                raise contracts.ContractError(f"no reads in {r.calibration_reads}")
        reads = settled(sequences.read_reads(spark, files))
    return Inputs(
        designs=designs.select(F.col("id").alias("design_id"), "target_taxid"),
        background=fasta("background", "background_id", strict=False).select("design_id", "sequence"),
        curated=fasta("curated_source_sequences", "source_sequence_id"), rules=rules, records=fasta("representative_queries", "query_id"),
        assembly=fasta("target_assembly", "assembly_sequence_id"), reference=reference, reads=reads, scope=scope.select("design_id", "taxid") if scope is not None else None,
    )


def facts(spark: SparkSession, designs: DataFrame, parameters: Parameters, run: Run) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inputs, parameters and versions of a run: files with their digests, values used, and what the steps taken rest on."""
    files = [(column, r.id, "file", r[column]) for r in designs.toLocalIterator() for column in _FILES if (r[column] or "").strip()]
    files += [("calibration_reads", r.id, "directory", r.calibration_reads) for r in designs.toLocalIterator() if (r.calibration_reads or "").strip()]
    used = spark.createDataFrame(sorted((k, str(v)) for k, v in vars(parameters).items()), "parameter string, value string")
    versions = {"spark": spark.version, "python": ".".join(map(str, __import__("sys").version_info[:3]))}
    if {"discovered_sources", "calibration"} & set(run.steps):
        versions["numpy"] = __import__("numpy").__version__  # the aligner's
    return provenance.provenance(provenance.file_facts(spark, files), used, spark.createDataFrame(sorted(versions.items()), "component string, version string"))


def publish(run: Run, designs: list[str], root: str, export: bool = True) -> dict[str, str]:
    """Writes each table under its stage, Parquet by design; `export`: also one text table for each design, with its header even
    where it has no rows. The manifest is published once, from the deepest stage that ran. Gives name: path."""
    kept = dict(run.tables)
    stage_of = dict(STAGE_OF)
    if "screened_manifest" in kept:
        stage_of["manifest"], kept["manifest"] = sinks.deepest_manifest(kept["manifest"], kept.pop("screened_manifest"))
    out = {}
    for name, df in kept.items():
        out[name] = sinks.write_table(df, root, stage_of[name], name)
        if export:
            for design in designs:
                one = df.where(F.col("design_id") == design)
                sinks.write_tsv(one, f"{root}/{sinks.STAGES[stage_of[name]]}/{design}/{name}", [c for c in df.columns if c not in ("design_id", "sequence")][:3])
    return out


def run_files(spark: SparkSession, design_csv: str, root: str, reference: str | None = None, parameters: Parameters | None = None, export: bool = True) -> Run:
    """A whole run: designs from a CSV of paths, results under `root`, provenance beside them."""
    p = parameters or Parameters()
    designs = settled(tables.read_designs(spark, design_csv))
    run = run_designs(read_inputs(spark, designs, tables.read_reference(spark, reference) if reference else None), p)
    # Nothing of the run's intermediate plans is computed again: what is published is read back.
    run = replace(run, tables={name: settled(df) for name, df in run.tables.items()})
    publish(run, [r.id for r in designs.select("id").orderBy("id").toLocalIterator()], root, export)
    for name, df in zip(("inputs", "parameters", "versions"), facts(spark, designs, p, run)):
        sinks.write_tsv(df, f"{root}/{sinks.STAGES['provenance']}/{name}", df.columns[:3])
    if "verification" in run.tables:
        text = report(run.tables["verification"])
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/{sinks.STAGES['index']}/report")
    return run



