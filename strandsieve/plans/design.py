"""A run over many designs: source acquisition, filtering, screening, index, calibration and provenance as one set of plans."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.operators import align, calibrate, candidates, discovery, panel, reads, screening
from strandsieve.session import fresh_path, settled
from strandsieve.sources.sinks import write_if_any, write_table


@dataclass
class Inputs:
    """Tables of a run, each with design_id where it belongs to a design.

    designs: design_id, target_taxid; curated: source_sequence_id, sequence; rules, records, assembly: discovery;
    background: sequence; reference: shared taxonomic reference; reads: metagenome_id, ordinal, sequence; scope: taxid.
    Hits may be given where an external aligner made them.
    """

    designs: DataFrame
    background: DataFrame
    curated: DataFrame | None = None
    rules: DataFrame | None = None
    records: DataFrame | None = None
    assembly: DataFrame | None = None
    locus_hits: DataFrame | None = None
    reference: DataFrame | None = None
    exact_hits: DataFrame | None = None
    reads: DataFrame | None = None
    scope: DataFrame | None = None
    read_hits: DataFrame | None = None


@dataclass
class Parameters:
    kmer_size: int = S.Defaults.kmer_size
    entropy_threshold: float = S.Defaults.entropy_threshold
    max_subjects: int = S.Defaults.max_subjects
    tie_tolerance: str = S.Defaults.tie_tolerance

    def __post_init__(self) -> None:
        """Values out of their ranges are errors before anything is read."""
        rules = (
            (isinstance(self.kmer_size, int) and self.kmer_size >= 1, "kmer_size must be at least 1"),
            (0 <= self.entropy_threshold <= 1, "entropy_threshold must be from 0 to 1"),
            (isinstance(self.max_subjects, int) and self.max_subjects >= 1, "max_subjects must be at least 1"),
            (bool(re.fullmatch(r"[0-9]+(\.[0-9]+)?", self.tie_tolerance)), "tie_tolerance must be a plain decimal"),
        )
        for holds, message in rules:
            if not holds:
                raise contracts.ContractError(f"parameters: {message}")


@dataclass
class Run:
    """Tables by name, and the steps that were taken (for provenance)."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    steps: list[str] = field(default_factory=list)

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        self.tables[name] = df
        return df

    def write(self, root: str) -> None:
        """Every table under its stage; tables without rows are left out."""
        for name, df in self.tables.items():
            stage = STAGE_OF[name]
            write_if_any(df, f"{root}/{stage}/{name}", lambda d, _, s=stage, n=name: write_table(d, root, s, n))


STAGE_OF = {
    "loci": "sources", "discovery_status": "sources", "sources": "sources", "manifest": "candidates", "occurrences": "candidates", "filtering_status": "candidates",
    "exact_hits": "screening", "decisions": "screening", "screening_status": "screening", "screened_manifest": "screening", "set_status": "panel", "panel": "panel",
    "verification": "index", "index_errors": "index", "index": "index", "read_counts": "calibration", "preparation": "calibration", "classified_reads": "calibration",
    "threshold_counts": "calibration", "threshold_summary": "calibration", "parameters": "provenance",
}


def find_sources(inputs: Inputs, run: Run) -> DataFrame:
    """Curated and discovered sources together; designs with an incomplete group end here."""
    parts = []
    if inputs.curated is not None:
        run.steps.append("curated_sources")
        parts.append(discovery.curated_sources(inputs.curated).select("design_id", "source_sequence_id", "query_group", "sequence"))
    if inputs.rules is not None:
        run.steps.append("discovered_sources")
        discovery.check_rules(inputs.rules)
        queries = settled(discovery.crop_queries(inputs.rules, inputs.records))
        hits = inputs.locus_hits if inputs.locus_hits is not None else align.locus_hits(queries, inputs.assembly)
        loci = run.keep("loci", settled(discovery.candidate_loci(hits, inputs.rules, queries, inputs.assembly)))
        found = discovery.provisional_sources(loci)
        status = run.keep("discovery_status", discovery.group_completeness(inputs.rules, found))
        parts.append(found.join(discovery.complete_designs(status), "design_id", "left_semi").select("design_id", "source_sequence_id", "query_group", "sequence"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return run.keep("sources", out)


def run_designs(inputs: Inputs, parameters: Parameters | None = None) -> Run:
    p, run = parameters or Parameters(), Run()
    k = p.kmer_size
    sources = settled(find_sources(inputs, run))
    occurrences = candidates.enumerate_kmers(sources, k)
    counts = settled(candidates.kmer_counts(occurrences))
    candidates.check_counters(counts, sources.select("design_id", "sequence"), k)
    cancelled = settled(candidates.background_counts(counts, inputs.background, k))
    manifest = settled(candidates.filter_complexity(settled(candidates.build_manifest(counts, cancelled)), p.entropy_threshold))
    run.steps += ["candidate_kmers", "complexity_filter"]
    run.keep("manifest", manifest)
    run.keep("occurrences", candidates.occurrence_table(occurrences, manifest))
    run.keep("filtering_status", candidates.filtering_status(manifest, inputs.designs))
    deepest = manifest
    if inputs.reference is not None or inputs.exact_hits is not None:
        run.steps.append("taxonomic_screening")
        local = candidates.panel_of(manifest)
        if inputs.exact_hits is not None:
            hits = screening.check_hits(screening.typed_hits(inputs.exact_hits), local, k)
        else:
            hits = screening.exact_match_hits(local, inputs.reference, k)
        hits = run.keep("exact_hits", settled(hits))
        decisions = run.keep("decisions", settled(screening.screening_decisions(local, hits, inputs.designs)))
        run.keep("screening_status", screening.screening_status(manifest, decisions, inputs.designs))
        deepest = run.keep("screened_manifest", settled(screening.apply_screening(manifest, decisions)))
    found = inputs.designs.select("design_id").limit(0) if inputs.rules is None else inputs.rules.select("design_id").distinct()
    marked = inputs.designs.select("design_id").join(found.withColumn("_found", F.lit(True)), "design_id", "left")
    origins = marked.select("design_id", F.when(F.col("_found"), S.DISCOVERED).otherwise(S.CURATED).alias("source_sequence_origin"))
    run.keep("set_status", screening.set_status(deepest, origins, screened=deepest is not manifest))
    members = run.keep("panel", settled(candidates.panel_of(deepest)))
    path = fresh_path(members.sparkSession, "index")
    panel.build_index(members, path, k)
    index = run.keep("index", panel.read_index(members.sparkSession, path))
    errors = run.keep("index_errors", settled(panel.index_errors(deepest, members, index, inputs.background, k)))
    panel.verify(errors)
    run.keep("verification", panel.verification_summary(index, errors, k))
    run.steps.append("verified_index")
    if inputs.reads is not None and (inputs.reference is not None or inputs.read_hits is not None):
        calibrate_panel(inputs, members, p, run)
    run.keep("parameters", run_facts(inputs.designs, p, run.steps))
    return run


def run_facts(designs: DataFrame, p: Parameters, steps: list[str]) -> DataFrame:
    """design_id, parameter and value: the parameters, the steps that were taken and the versions, for each design."""
    spark = designs.sparkSession
    facts = [*((k, str(v)) for k, v in vars(p).items()), *((f"step_{i:02d}", s) for i, s in enumerate(steps, 1)), ("spark_version", spark.version)]
    rows = F.array(*[F.struct(F.lit(k).alias("parameter"), F.lit(v).alias("value")) for k, v in sorted(facts)])
    return designs.select("design_id").distinct().select("design_id", F.explode(rows).alias("f")).select("design_id", "f.*")


def calibrate_panel(inputs: Inputs, members: DataFrame, p: Parameters, run: Run) -> None:
    run.steps.append("calibration")
    counted = settled(reads.count_panel_kmers(inputs.reads, members, p.kmer_size))
    run.keep("read_counts", counted.select("design_id", *S.READ_COUNTS))
    returned = counted.groupBy("design_id").agg(F.count(F.lit(1)).alias("returned"))
    designs = inputs.designs.join(inputs.reads.select("design_id").distinct(), "design_id", "left_semi")
    preparation = run.keep("preparation", settled(reads.preparation_summary(counted, returned, designs)))
    queries = reads.read_queries(counted)
    if inputs.read_hits is not None:
        hits = align.keep_best_subjects(calibrate.check_read_hits(inputs.read_hits, queries), p.max_subjects)
    else:
        hits = align.read_hits(queries, inputs.reference, p.max_subjects)
    scoped = calibrate.hit_scope(hits, calibrate.calibration_scope(inputs.designs, inputs.scope))
    classified = run.keep("classified_reads", settled(calibrate.classify_reads(counted, calibrate.representative_scores(scoped), p.tie_tolerance)))
    curve = run.keep("threshold_counts", settled(calibrate.threshold_curve(classified, designs)))
    calibrate.check_agreement(curve, preparation)
    run.keep("threshold_summary", calibrate.threshold_summary(curve, preparation))
