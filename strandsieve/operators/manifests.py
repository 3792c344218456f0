"""Contracts of imported tables between stages: manifests, panel FASTA, query groups and panel status.

Tables come as text with `row`, their place in the file from 0 (`sources.order`), and with design_id; checks are ordered, and of
each table the first bad row of the first design decides the error. Checks that look at the row before get it chunk by chunk,
those that count equal values count them by key, so no check gathers a table in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.functions.sequence import canonical, is_dna, padded_id
from strandsieve.session import settled
from strandsieve.sources.order import with_before

#: Stages at which a manifest is taken in, each with its own order of checks.
FILTERING, SCREENING, VERIFICATION = "complexity filter", "taxonomic screening", "verification"
_EVIDENCE = ("bait_id", "on_target_hits", "off_target_hits")
_NUMBER, _STATED_NUMBER = "^[0-9]+$", "^(0|[1-9][0-9]*)$"


def _repeated(rows: DataFrame, keys: Sequence[str], into: str) -> DataFrame:
    """Adds whether another row has the same keys; blanks are never the same."""
    again = contracts.duplicate_keys(rows.where(F.col(keys[-1]) != ""), keys).select(*keys, F.lit(True).alias(into))
    return rows.join(again, list(keys), "left").withColumn(into, F.coalesce(into, F.lit(False)))


def _count(column: str, least: int) -> Column:
    """The column is a whole number of at least so much."""
    return F.coalesce(F.col(column).rlike(_NUMBER) & (F.col(column).try_cast("long") >= least), F.lit(False))


def _blank(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def _state(status: str, reason: str, screening: str, background: bool) -> Column:
    found = F.col("background_occurrences").try_cast("long")
    return (F.col("status") == status) & (F.col("rejection_reason") == reason) & (F.col("taxonomic_screening_status") == screening) & ((found > 0) if background else (found == 0))


def manifest_checks(stage: str, k: int | None) -> list[tuple[Column, str | Column]]:
    """The ordered checks of a manifest that a stage takes in; rows have `before`, `_again` and `_named` beside their columns."""
    c = F.col
    say = lambda text, of="candidate_kmer_id": F.concat(F.lit(f"{text} "), F.coalesce(c(of), F.lit("")))
    needed = [x for x in S.MANIFEST if x not in _EVIDENCE] if stage != VERIFICATION else ["candidate_kmer_id", "kmer", "status", "rejection_reason", "taxonomic_screening_status"]
    no_hits = _blank("on_target_hits") & _blank("off_target_hits")
    named, unnamed = ~_blank("bait_id"), _blank("bait_id")
    background = _state(S.REJECT_BACKGROUND, S.BACKGROUND_OCCURRENCE, S.NOT_APPLICABLE, True) & unnamed & no_hits
    low = _state(S.REJECT_COMPLEXITY, S.LOW_COMPLEXITY, S.NOT_APPLICABLE, False) & unnamed & no_hits
    local = _state(S.PASS, S.NONE, S.NOT_RUN, False)
    missing = (contracts.any_of([c(x).isNull() | (c(x) == "") for x in needed]), "missing field")
    sequential = (c("candidate_kmer_id") != padded_id("candidate_kmer", c("row") + 1), say("invalid or non-sequential id"))
    in_order = (c("kmer") < c("before"), say("not sorted by k-mer at"))
    malformed = ~is_dna(c("kmer")) if k is None else ~is_dna(c("kmer")) | (F.length("kmer") != k)
    shape = (malformed, say("invalid k-mer", "kmer"))
    turned = (c("kmer") != canonical(c("kmer")), say("noncanonical k-mer", "kmer"))
    twice = (c("_again"), say("duplicate k-mer", "kmer"))
    name_twice = (c("_named"), say("duplicate panel id", "bait_id"))
    copies, found = (~_count("source_copy_count", 1), say("invalid source_copy_count for")), (~_count("background_occurrences", 0), say("invalid background_occurrences for"))
    if stage == FILTERING:
        return [missing, sequential, in_order, shape, turned, twice, copies, found, (~(unnamed & no_hits), say("evidence before the complexity filter for")), (~(local & unnamed | background), say("inconsistent state for"))]
    if stage == SCREENING:
        return [missing, sequential, in_order, shape, turned, twice, name_twice, copies, found, (~no_hits, say("hits before screening for")), (~(local & named | background | low), say("inconsistent state for"))]
    whole = lambda column, least: _count(column, least)
    screened = _state(S.PASS, S.NONE, S.PASS, False) & named & whole("on_target_hits", 0) & (c("off_target_hits") == "0")
    rejected = _state(S.REJECT_OFF_TARGET, S.OFF_TARGET_MATCH, S.REJECT_OFF_TARGET, False) & named & whole("on_target_hits", 0) & whole("off_target_hits", 1)
    identity = (contracts.any_of([malformed, ~c("candidate_kmer_id").startswith("candidate_kmer_")]), say("invalid identity or k-mer", "kmer"))
    states = local & named & no_hits | screened | rejected | background | low
    return [missing, identity, sequential, in_order, turned, twice, name_twice, copies, found, (~F.coalesce(states, F.lit(False)), say("incoherent state for"))]


def check_manifest(manifest: DataFrame, stage: str, k: int | None = None) -> DataFrame:
    """The manifest (design_id, row and its columns as text) with numbers and blanks in place, if the stage can take it in.

    What the whole table must have: rows, a row to go on with, and one length of k-mers.
    """
    rows = settled(with_before(manifest, ["design_id"], "kmer"))
    rows = settled(_repeated(_repeated(rows, ["design_id", "kmer"], "_again"), ["design_id", "bait_id"], "_named"))
    contracts.require_rows(rows, stage)
    contracts.require(rows, manifest_checks(stage, k), ["design_id", "row"], stage)
    per = rows.groupBy("design_id").agg(F.count_if(F.col("status") == S.PASS).alias("open"), F.count_distinct(F.length("kmer")).alias("lengths"))
    if stage != VERIFICATION:
        contracts.require(per, [(F.col("open") == 0, F.concat(F.lit("no eligible k-mer in "), F.col("design_id")))], ["design_id"], stage)
    contracts.require(per, [(F.col("lengths") > 1, F.concat(F.lit("k-mers of different lengths in "), F.col("design_id")))], ["design_id"], stage)
    numbers = ("source_copy_count", "background_occurrences", "on_target_hits", "off_target_hits")
    typed = {**{c: F.col(c).try_cast("long") for c in numbers}, "bait_id": F.coalesce("bait_id", F.lit(""))}
    return rows.withColumns(typed).select("design_id", *S.MANIFEST)


def check_panel_records(records: DataFrame, k: int) -> DataFrame:
    """design_id, bait_id and sequence of a panel FASTA (design_id, id, description, sequence, row): sequential ids in k-mer order."""
    rows = settled(with_before(records, ["design_id"], "sequence"))
    rows = settled(_repeated(_repeated(rows, ["design_id", "id"], "_named"), ["design_id", "sequence"], "_again"))
    contracts.require_rows(rows, "panel FASTA")
    c = F.col
    order = ["design_id", "row"]
    # Each check is of the whole table before the next one.
    for check in (
        (_blank("id") | ~_blank("description"), F.concat(F.lit("invalid id or description: "), c("id"))),
        (c("_named"), F.concat(F.lit("duplicate id "), c("id"))),
        (c("_again"), F.concat(F.lit("duplicate sequence "), c("sequence"))),
        ((F.length("sequence") != k) | ~is_dna(c("sequence")), F.concat(F.lit(f"malformed {k}-mer "), c("sequence"))),
        (c("sequence") != canonical(c("sequence")), F.concat(F.lit("noncanonical k-mer "), c("sequence"))),
        (c("id") != padded_id("bait", c("row") + 1), F.concat(F.lit("ids are not sequential at "), c("id"))),
        (c("sequence") < c("before"), F.concat(F.lit("not sorted by k-mer at "), c("id"))),
    ):
        contracts.require(rows, [check], order, "panel FASTA")
    return rows.select("design_id", c("id").alias("bait_id"), "sequence")


def check_query_groups(groups: DataFrame, sources: DataFrame) -> DataFrame:
    """design_id, source_sequence_id and query_group (blank for null), if each source has one row and each row a source."""
    keys = ["design_id", "source_sequence_id"]
    rows = settled(_repeated(groups, keys, "_again"))
    checks = [
        (_blank("source_sequence_id"), "blank source sequence id"),
        (F.col("_again"), F.concat(F.lit("duplicate source sequence id "), F.col("source_sequence_id"))),
    ]
    contracts.require(rows, checks, ["design_id", "row"], "query groups")
    contracts.require_present(sources, rows, keys, "query groups (no group)")
    contracts.require_present(rows, sources, keys, "query groups (no source)")
    return rows.select(*keys, F.coalesce("query_group", F.lit("")).alias("query_group"))


# Metrics of the status of a panel, in order, and what they may say.
STATUS_METRICS = (
    "design_id", "source_sequence_origin", "candidate_kmer_count", "locally_filtered_bait_count", "taxonomic_screening_status",
    "taxonomically_screened_bait_count", "deepest_bait_set", "deacon_index_source",
)
ORIGINS, SETS = (S.CURATED, S.DISCOVERED), ("locally_filtered", "taxonomically_screened")


def check_set_status(status: DataFrame) -> DataFrame:
    """A row for each design of its (ordinal, metric, value) status, if that is coherent before verification."""
    listed = status.groupBy("design_id").agg(F.array_sort(F.collect_list(F.struct("ordinal", "metric", F.coalesce("value", F.lit("")).alias("value")))).alias("m"))
    names = F.transform("m", lambda x: x["metric"])
    contracts.require(listed, [(names != F.array(*map(F.lit, STATUS_METRICS)), "unexpected metrics or order")], ["design_id"], "panel status")
    wide = listed.select(F.col("design_id").alias("_design"), *[F.col("m")[i]["value"].alias(n) for i, n in enumerate(STATUS_METRICS)])
    c = F.col
    number = lambda n: c(n).rlike(_STATED_NUMBER) & c(n).try_cast("long").isNotNull()
    none = c("taxonomically_screened_bait_count") == ""
    local = (c("deepest_bait_set") == SETS[0]) & (c("taxonomic_screening_status") == S.NOT_RUN) & none
    screened = (c("deepest_bait_set") == SETS[1]) & (c("taxonomic_screening_status") == S.PASS) & ~none & (c("taxonomically_screened_bait_count").try_cast("long") > 0)
    supported = c("source_sequence_origin").isin(*ORIGINS) & c("taxonomic_screening_status").isin(S.PASS, S.NOT_RUN, S.STAGE_EMPTY_PANEL) & c("deepest_bait_set").isin(*SETS) & c("deacon_index_source").isin("", *SETS)
    checks = [
        (c("design_id") != c("_design"), "another design's status"),
        (~supported, "unsupported state"),
        (~number("candidate_kmer_count"), "invalid candidate_kmer_count"),
        (~number("locally_filtered_bait_count"), "invalid locally_filtered_bait_count"),
        (~none & ~number("taxonomically_screened_bait_count"), "invalid taxonomically_screened_bait_count"),
        (c("deacon_index_source") != "", "an index before verification"),
        (~F.coalesce(local | screened, F.lit(False)), "incoherent before verification"),
    ]
    contracts.require(wide, checks, ["_design"], "panel status")
    return wide.drop("_design")
