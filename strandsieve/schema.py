"""Tables of the engine: column order is part of the contract. Every table also carries `design_id` as its first column."""

from __future__ import annotations

# Names and order of columns, states and reasons.
MANIFEST = (
    "candidate_kmer_id", "bait_id", "kmer", "source_copy_count", "background_occurrences", "status", "rejection_reason",
    "taxonomic_screening_status", "on_target_hits", "off_target_hits",
)
OCCURRENCES = ("candidate_kmer_id", "source_sequence_id", "start", "query_group")
QUERY_RULES = ("query_id", "query_group", "query_start", "query_end", "min_identity", "min_query_coverage")
LOCI = (
    "candidate_locus_id", "source_sequence_id", "query_id", "query_group", "assembly_sequence_id", "assembly_start",
    "assembly_end", "strand", "percent_identity", "query_coverage",
)
DISCOVERY_STATUS = ("query_group", "status", "provisional_source_sequence_count")
SCREENING_DECISIONS = ("bait_id", "taxonomic_screening_status", "on_target_hits", "off_target_hits")
LOCUS_HITS = (
    "query_id", "query_length", "query_start", "query_end", "assembly_sequence_id", "assembly_start_raw", "assembly_end_raw",
    "alignment_length", "percent_identity",
)
EXACT_HITS = (
    "qseqid", "saccver", "staxids", "sscinames", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart",
    "send", "stitle",
)
READ_HITS = (
    "qseqid", "qlen", "saccver", "staxids", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send",
    "evalue", "bitscore", "qcovhsp", "stitle",
)
READ_COUNTS = ("metagenome_id", "read_id", "read_length", "bait_count", "representative_id")
CLASSIFIED = (*READ_COUNTS, "classification", "best_target_bit_score", "best_non_target_bit_score")
THRESHOLD_COUNTS = ("threshold", "target_read_count", "non_target_read_count", "tied_read_count", "no_hit_read_count")
PREPARATION = ("design_id", "deacon_returned_read_count", "candidate_read_count", "duplicate_sequence_count", "read_blast_query_count")

PASS, NOT_RUN, NOT_APPLICABLE, NONE = "PASS", "NOT_RUN", "NOT_APPLICABLE", "none"
REJECT_BACKGROUND, REJECT_COMPLEXITY, REJECT_OFF_TARGET = "REJECT_INTERFERENCE_BACKGROUND", "REJECT_LOW_COMPLEXITY", "REJECT_OFF_TARGET_HIT"
BACKGROUND_OCCURRENCE, LOW_COMPLEXITY, OFF_TARGET_MATCH = "background_occurrence", "low_complexity", "off_target_exact_match"
TARGET, NON_TARGET, TIED, NO_HIT = "TARGET", "NON_TARGET", "TIED", "NO_HIT"
CLASSES = (TARGET, NON_TARGET, TIED, NO_HIT)
CURATED, DISCOVERED = "curated_input", "discovered_loci"

# What the stages at which a design can end are called in the tables.
STAGE_ENUMERATION, STAGE_CANCELLED = "candidate_kmer_enumeration", "explicit_background_cancellation"
STAGE_COMPLEXITY, STAGE_EMPTY_PANEL = "low_complexity_filtering", "NO_BAITS"
NO_CANDIDATE_LOCUS, NO_CANDIDATE_READS = "NO_CANDIDATE_LOCUS", "NO_CANDIDATE_READS"
RECOMMENDED, UNSUPPORTED = "RECOMMENDED_THRESHOLD", "NO_SUPPORTED_THRESHOLD"


class Defaults:
    """Parameters of a run unless it says otherwise."""

    kmer_size = 31
    window = 1
    entropy_threshold = 0.6
    max_subjects = 100
    shards = 4
    tie_tolerance = "0.1"
    max_evalue = 1e-10
