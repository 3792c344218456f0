"""Source sequences: curated ones normalised, or loci found in an assembly by rule-driven alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.functions.ranking import numbered_by
from strandsieve.functions.sequence import normalize, padded_id, reverse_complement, subsequence
from strandsieve.session import settled, small

_FINITE = lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))

# What a locus is known by, in the order in which loci are numbered.
_LOCUS = ("query_group", "sequence", "query_id", "assembly_sequence_id", "assembly_start", "assembly_end", "strand", "percent_identity", "query_coverage")


def curated_sources(records: DataFrame) -> DataFrame:
    """(design_id, source_sequence_id, sequence) upper-cased with U as T, in one blank query group."""
    contracts.require_rows(records, "source sequences")
    contracts.require_unique(records, ["design_id", "source_sequence_id"], "source sequences")
    out = records.select("design_id", "source_sequence_id", normalize(F.col("sequence")).alias("sequence"), F.lit("").alias("query_group"))
    return check_sources(out)


def check_sources(sources: DataFrame) -> DataFrame:
    checks = [
        (contracts.blank("source_sequence_id"), "blank source sequence id"),
        (contracts.blank("sequence"), F.concat(F.lit("empty sequence "), F.col("source_sequence_id"))),
        (~F.col("sequence").rlike("^[ACGTRYKMSWBDHVN]+$"), F.concat(F.lit("not upper-case IUPAC: "), F.col("source_sequence_id"))),
    ]
    return contracts.require(sources, checks, ["design_id", "source_sequence_id"], "source sequences")


def check_rules(rules: DataFrame) -> DataFrame:
    """Ordered checks of the query rules, first by interval, then by group and thresholds."""
    contracts.require_rows(rules, "query rules")
    checks = [
        (contracts.blank("query_id"), "blank query_id"),
        ((F.col("query_start") < 1) | F.col("query_start").isNull() | F.col("query_end").isNull() | (F.col("query_end") < 0), F.concat(F.lit("invalid interval for "), F.col("query_id"))),
        ((F.col("query_end") != 0) & (F.col("query_end") < F.col("query_start")), F.concat(F.lit("invalid interval for "), F.col("query_id"))),
        (contracts.blank("query_group"), F.concat(F.lit("blank query_group for "), F.col("query_id"))),
        (~F.coalesce(F.col("min_identity").between(0, 100), F.lit(False)), F.concat(F.lit("min_identity outside 0 to 100 for "), F.col("query_id"))),
        (~F.coalesce(F.col("min_query_coverage").between(0, 100), F.lit(False)), F.concat(F.lit("min_query_coverage outside 0 to 100 for "), F.col("query_id"))),
    ]
    contracts.require(rules, checks, contracts.order_of(rules, "design_id", "query_id"), "query rules")
    return contracts.require_unique(rules, ["design_id", "query_id"], "query rules")


def crop_queries(rules: DataFrame, records: DataFrame, check: bool = True) -> DataFrame:
    """design_id, query_id and the rule's part of the record: 1-based, both ends included, end 0 for the record's end."""
    if check:
        contracts.require_unique(records, ["design_id", "query_id"], "query records")
        contracts.require_present(rules, records, ["design_id", "query_id"], "query rules")
    end = F.when(F.col("query_end") == 0, F.length("sequence")).otherwise(F.col("query_end"))
    joined = rules.join(records.select("design_id", "query_id", "sequence"), ["design_id", "query_id"], "left").withColumn("_end", end)
    if check:
        beyond = (F.col("_end") > F.length("sequence")) | (F.col("query_start") > F.length("sequence"))
        contracts.require(joined, [(beyond, F.concat(F.lit("interval beyond record "), F.col("query_id")))], ["design_id", "query_id"], "query rules")
    return joined.select("design_id", "query_id", subsequence(F.col("sequence"), F.col("query_start"), F.col("_end")).alias("sequence"))


def contextual_hits(hits: DataFrame, rules: DataFrame, queries: DataFrame, assembly: DataFrame) -> DataFrame:
    """Hits with their rule, prepared query length, and the length of their assembly record with its part that they name.

    Whole records move once, to where their distinct intervals are; what goes on to the hits is the parts.
    """
    r = small(settled(rules.select("design_id", "query_id", "query_group", "min_identity", "min_query_coverage")))
    q = small(settled(queries.select("design_id", "query_id", F.length("sequence").cast("long").alias("_prepared"))))
    interval = ["design_id", "assembly_sequence_id", "assembly_start_raw", "assembly_end_raw"]
    part = normalize(subsequence(F.col("sequence"), F.least("assembly_start_raw", "assembly_end_raw"), F.greatest("assembly_start_raw", "assembly_end_raw")))
    named = assembly.select("design_id", "assembly_sequence_id", "sequence").join(hits.select(*interval).distinct(), ["design_id", "assembly_sequence_id"])
    parts = settled(named.select(*interval, F.length("sequence").alias("_length"), part.alias("_part")))
    return hits.join(r, ["design_id", "query_id"], "left").join(q, ["design_id", "query_id"], "left").join(small(parts), interval, "left")


def check_locus_hits(contextual: DataFrame) -> DataFrame:
    """Ten ordered checks of alignment rows."""
    c = F.col
    say = lambda text, of: F.concat(F.lit(f"{text} "), c(of))
    span = F.abs(c("assembly_end_raw") - c("assembly_start_raw")) + 1
    checks = [
        (contracts.any_of([c(x).isNull() for x in S.LOCUS_HITS]), "missing alignment field"),
        (c("query_group").isNull() | c("_prepared").isNull(), say("unknown query", "query_id")),
        (c("_length").isNull(), say("unknown assembly record", "assembly_sequence_id")),
        (c("query_length") <= 0, say("invalid query length for", "query_id")),
        (c("query_length") != c("_prepared"), say("inconsistent query length for", "query_id")),
        ((c("query_start") < 1) | (c("query_start") > c("query_end")) | (c("query_end") > c("query_length")), say("invalid query interval for", "query_id")),
        ((F.least("assembly_start_raw", "assembly_end_raw") < 1) | (F.greatest("assembly_start_raw", "assembly_end_raw") > c("_length")), say("invalid assembly interval for", "assembly_sequence_id")),
        (c("alignment_length") <= 0, say("invalid alignment length for", "query_id")),
        (~(_FINITE(c("percent_identity")) & c("percent_identity").between(0, 100)), say("invalid identity for", "query_id")),
        ((c("alignment_length") < c("query_end") - c("query_start") + 1) | (c("alignment_length") < span), say("inconsistent alignment length for", "query_id")),
    ]
    return contracts.require(contextual, checks, contracts.order_of(contextual, *S.LOCUS_HITS), "locus hits")


def accepted_loci(hits: DataFrame, rules: DataFrame, queries: DataFrame, assembly: DataFrame, check: bool = True) -> DataFrame:
    """Loci that meet both thresholds (inclusive), with their sequence in query direction. `hits` is read twice."""
    contextual = settled(contextual_hits(hits, rules, queries, assembly))
    if check:
        contracts.require_present(rules, queries, ["design_id", "query_id"], "query rules")
        check_locus_hits(contextual)
    coverage = (F.col("query_end") - F.col("query_start") + 1) / F.col("query_length") * 100
    placed = contextual.withColumns({
        "assembly_start": F.least("assembly_start_raw", "assembly_end_raw"),
        "assembly_end": F.greatest("assembly_start_raw", "assembly_end_raw"),
        "strand": F.when(F.col("assembly_start_raw") <= F.col("assembly_end_raw"), "+").otherwise("-"),
        "query_coverage": coverage,
    }).where((F.col("percent_identity") >= F.col("min_identity")) & (F.col("query_coverage") >= F.col("min_query_coverage")))
    placed = placed.withColumn("sequence", F.when(F.col("strand") == "+", F.col("_part")).otherwise(reverse_complement(F.col("_part"))))
    return placed.select("design_id", *_LOCUS)


def candidate_loci(hits: DataFrame, rules: DataFrame, queries: DataFrame, assembly: DataFrame, check: bool = True) -> DataFrame:
    """Accepted loci with their ids."""
    loci = numbered_by(accepted_loci(hits, rules, queries, assembly, check), ["design_id"], list(_LOCUS), "_number").withColumn("candidate_locus_id", padded_id("candidate_locus", F.col("_number")))
    named = loci.join(provisional_sources(loci), ["design_id", "query_group", "sequence"], "left")
    return named.select("design_id", *S.LOCI, "sequence")


def provisional_sources(loci: DataFrame) -> DataFrame:
    """Distinct (query_group, sequence), numbered in that order."""
    distinct = loci.select("design_id", "query_group", "sequence").distinct()
    named = numbered_by(distinct, ["design_id"], ["query_group", "sequence"], "_number")
    return named.withColumn("source_sequence_id", padded_id("source_sequence", F.col("_number"))).drop("_number")


def group_completeness(rules: DataFrame, sources: DataFrame) -> DataFrame:
    """Each group that the rules name, and how many sources it has."""
    n = sources.groupBy("design_id", "query_group").agg(F.count(F.lit(1)).alias("provisional_source_sequence_count"))
    joined = rules.select("design_id", "query_group").distinct().join(n, ["design_id", "query_group"], "left").fillna(0, ["provisional_source_sequence_count"])
    status = F.when(F.col("provisional_source_sequence_count") > 0, S.PASS).otherwise(S.NO_CANDIDATE_LOCUS)
    return joined.withColumn("status", status).select("design_id", *S.DISCOVERY_STATUS)


def complete_designs(status: DataFrame) -> DataFrame:
    """Designs all of whose groups have a source; the others end here."""
    return status.groupBy("design_id").agg(F.bool_and(F.col("provisional_source_sequence_count") > 0).alias("_all")).where("_all").select("design_id")
