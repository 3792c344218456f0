"""Candidate k-mers: enumeration, background cancellation, complexity, identifiers and status. Many designs are one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.functions import packed
from strandsieve.functions.ranking import numbered
from strandsieve.functions.sequence import canonical, is_dna, normalize, padded_id, scaled_entropy, tiles, windows

#: Distinct candidates that may be broadcast against the background; beyond that the join is shuffled.
BROADCAST_CANDIDATES = 400_000


def enumerate_kmers(sources: DataFrame, k: int, columns: tuple[str, ...] = ("design_id", "source_sequence_id", "query_group")) -> DataFrame:
    """`columns`, start (0-based) and canonical kmer of each window of A, C, G and T of `sequence`."""
    if k <= packed.MOST:
        both = packed.coded(sources, k, columns).select(*columns, F.explode(F.arrays_zip("starts", "codes")).alias("_w"))
        return both.select(*columns, F.col("_w.starts").alias("start"), packed.unpack(F.col("_w.codes"), k).alias("kmer"))
    size = 1 << 16
    piece = sources.select(*columns, F.posexplode(tiles(F.col("sequence"), k, size)).alias("_tile", "_piece"))
    window = piece.select(*columns, "_tile", F.posexplode(windows(F.col("_piece"), k)).alias("_at", "_window"))
    start = F.col("_tile").cast("long") * size + F.col("_at")
    return window.where(is_dna(F.col("_window"))).select(*columns, start.alias("start"), canonical(F.col("_window")).alias("kmer"))


def kmer_counts(occurrences: DataFrame, keys: tuple[str, ...] = ("design_id",)) -> DataFrame:
    """Positional copies of each canonical k-mer; summed on the map side first."""
    return occurrences.groupBy(*keys, "kmer").agg(F.count(F.lit(1)).alias("source_copy_count"))


def sequence_code_counts(sequences: DataFrame, k: int, keys: tuple[str, ...] = ("design_id",)) -> DataFrame:
    """keys, code and source_copy_count of `sequences` (keys, sequence), by sums of sorted arrays of codes."""
    return packed.counted(sequences, k, keys).withColumnRenamed("n", "source_copy_count")


def sequence_profile(sequences: DataFrame, k: int, keys: tuple[str, ...] = ("design_id",)) -> DataFrame:
    """keys, windows, kmers (distinct), first_kmer and last_kmer of `sequences`; keys without a window have no row."""
    n = packed.profiled(sequences, k, keys)
    # Codes are ordered as their texts are.
    return n.select(*keys, "windows", "kmers", packed.unpack(F.col("first"), k).alias("first_kmer"), packed.unpack(F.col("last"), k).alias("last_kmer"))


def sequence_kmer_counts(sequences: DataFrame, k: int, keys: tuple[str, ...] = ("design_id",)) -> DataFrame:
    """`kmer_counts` of `sequences` by a counter of its own; texts are made of the sums alone."""
    if k > packed.MOST:
        return kmer_counts(enumerate_kmers(sequences, k, keys), keys)
    return sequence_code_counts(sequences, k, keys).select(*keys, packed.unpack(F.col("code"), k).alias("kmer"), "source_copy_count")


def check_counters(counts: DataFrame, sequences: DataFrame, k: int) -> None:
    """The two counters must agree on k-mers and copies: `counts` from rows of windows, the others from sorted arrays."""
    theirs = sequence_kmer_counts(sequences, k).withColumnRenamed("source_copy_count", "count")
    bad = count_differences(counts, theirs).orderBy("design_id", "kmer").first()
    if bad is not None:
        raise contracts.ContractError(f"k-mer counts: {bad.kmer} of {bad.design_id} counted {bad.ours} and {bad.theirs} times")


def imported_counts(counts: DataFrame, k: int) -> DataFrame:
    """Third-party (design_id, kmer, count) rows, as text or numbers, checked and made canonical."""
    checks = [
        (F.col("kmer").isNull() | ~is_dna(F.col("kmer")), "k-mer is not DNA"),
        (F.length("kmer") != k, F.format_string("k-mer length is not %d", F.lit(k))),
        (~F.coalesce(F.col("count").cast("string").rlike("^[0-9]+$") & (F.col("count").try_cast("long") > 0), F.lit(False)), "count is not positive"),
    ]
    contracts.require(counts, checks, contracts.order_of(counts, "kmer"), "k-mer counts")
    made = counts.select("design_id", canonical(F.col("kmer")).alias("kmer"), F.col("count").cast("long").alias("count"))
    return contracts.require_unique(made, ["design_id", "kmer"], "k-mer counts")


def count_differences(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """K-mers on which two counters differ: a full join on the key, null where one side lacks it."""
    a = ours.select("design_id", "kmer", F.col("source_copy_count").alias("ours"))
    b = theirs.select("design_id", "kmer", F.col("count").alias("theirs"))
    return a.join(b, ["design_id", "kmer"], "full").where(~F.col("ours").eqNullSafe(F.col("theirs")))


def background_counts(candidates: DataFrame, background: DataFrame, k: int, broadcast: bool | None = None) -> DataFrame:
    """Copies in `background` (design_id, sequence) of each of `candidates` (design_id, kmer).

    Windows of the background are cut down to candidates before they are counted, as the background is much larger.
    """
    wanted = candidates.select("design_id", "kmer")
    if broadcast is None:
        broadcast = wanted.limit(BROADCAST_CANDIDATES + 1).count() <= BROADCAST_CANDIDATES
    if k <= packed.MOST:
        coded = wanted.select("design_id", packed.pack(F.col("kmer")).alias("code"))
        found = packed.code_rows(background, k, ("design_id",), lenient=True, only=packed.wanted(coded))
        hits = found.join(F.broadcast(coded) if broadcast else coded, ["design_id", "code"], "left_semi").groupBy("design_id", "code").agg(F.count(F.lit(1)).alias("background_occurrences"))
        return hits.select("design_id", packed.unpack(F.col("code"), k).alias("kmer"), "background_occurrences")
    cleaned = background.select("design_id", normalize(F.col("sequence")).alias("sequence"))
    found = enumerate_kmers(cleaned, k, ("design_id",)).select("design_id", "kmer")
    hits = found.join(F.broadcast(wanted) if broadcast else wanted, ["design_id", "kmer"], "left_semi")
    return hits.groupBy("design_id", "kmer").agg(F.count(F.lit(1)).alias("background_occurrences"))


def _state(background: Column) -> dict[str, Column]:
    rejected = background > 0
    return {
        "status": F.when(rejected, S.REJECT_BACKGROUND).otherwise(S.PASS),
        "rejection_reason": F.when(rejected, S.BACKGROUND_OCCURRENCE).otherwise(S.NONE),
        "taxonomic_screening_status": F.when(rejected, S.NOT_APPLICABLE).otherwise(S.NOT_RUN),
    }


def build_manifest(counts: DataFrame, in_background: DataFrame) -> DataFrame:
    """The manifest before the complexity filter: every candidate, numbered by k-mer within its design."""
    joined = counts.join(in_background, ["design_id", "kmer"], "left").withColumn("background_occurrences", F.coalesce("background_occurrences", F.lit(0)).cast("long"))
    named = numbered(joined, ["design_id"], "kmer", "_number")
    return named.withColumns({
        "candidate_kmer_id": padded_id("candidate_kmer", F.col("_number")),
        "bait_id": F.lit(""),
        "on_target_hits": F.lit(None).cast("long"),
        "off_target_hits": F.lit(None).cast("long"),
        **_state(F.col("background_occurrences")),
    }).select("design_id", *S.MANIFEST)


def occurrence_table(occurrences: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row for each source window, with its candidate's id."""
    return occurrences.join(manifest.select("design_id", "kmer", "candidate_kmer_id"), ["design_id", "kmer"]).select("design_id", *S.OCCURRENCES)


def eligible(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status") == S.PASS)


def passing_complexity(manifest: DataFrame, threshold: float = S.Defaults.entropy_threshold) -> DataFrame:
    """design_id and kmer of eligible candidates that are complex enough."""
    return eligible(manifest).where(scaled_entropy(F.col("kmer")) >= threshold).select("design_id", "kmer")


def apply_passing(manifest: DataFrame, passing: DataFrame) -> DataFrame:
    """Rejects eligible candidates that are not among `passing` (in either orientation), and numbers the others as the panel."""
    marked = passing.select("design_id", canonical(F.col("kmer")).alias("kmer"), F.lit(True).alias("_passes")).distinct()
    joined = manifest.join(marked, ["design_id", "kmer"], "left").withColumn("_passes", F.coalesce("_passes", F.lit(False)))
    return _name_panel(joined)


def filter_complexity(manifest: DataFrame, threshold: float = S.Defaults.entropy_threshold, window: int = S.Defaults.window) -> DataFrame:
    """`apply_passing` with the scaled entropy of each k-mer, without a join."""
    if window != 1:
        raise ValueError("only window 1, where every k-mer is indexed, is defined")
    return _name_panel(manifest.withColumn("_passes", scaled_entropy(F.col("kmer")) >= threshold))


def _name_panel(marked: DataFrame) -> DataFrame:
    open_ = F.col("status") == S.PASS
    low = open_ & ~F.col("_passes")
    # All right-hand sides see the old values: a rejected row is never reactivated.
    judged = marked.withColumns({
        "status": F.when(low, S.REJECT_COMPLEXITY).otherwise(F.col("status")),
        "rejection_reason": F.when(low, S.LOW_COMPLEXITY).otherwise(F.col("rejection_reason")),
        "taxonomic_screening_status": F.when(low, S.NOT_APPLICABLE).otherwise(F.col("taxonomic_screening_status")),
        "_member": open_ & F.col("_passes"),
    })
    kept = numbered(judged.where("_member").select("design_id", "kmer"), ["design_id"], "kmer", "_number")
    named = judged.drop("bait_id").join(kept.select("design_id", "kmer", padded_id("bait", F.col("_number")).alias("bait_id")), ["design_id", "kmer"], "left")
    return named.withColumn("bait_id", F.coalesce("bait_id", F.lit(""))).select("design_id", *S.MANIFEST)


def panel_of(manifest: DataFrame) -> DataFrame:
    """design_id, bait_id and sequence of what is still in the panel."""
    return eligible(manifest).where("bait_id <> ''").select("design_id", "bait_id", F.col("kmer").alias("sequence"))


def filtering_status(manifest: DataFrame, designs: DataFrame) -> DataFrame:
    """design_id, ordinal, metric and value: counts by state and the terminal stage, for every design."""
    n = manifest.groupBy("design_id").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.count_if(F.col("status") == S.REJECT_BACKGROUND).alias("background"),
        F.count_if(F.col("status") == S.REJECT_COMPLEXITY).alias("low"),
        F.count_if((F.col("status") == S.PASS) | (F.col("status") == S.REJECT_OFF_TARGET)).alias("kept"),
    )
    n = designs.select("design_id").distinct().join(n, "design_id", "left").fillna(0)
    stage = (
        F.when(F.col("candidates") == 0, S.STAGE_ENUMERATION)
        .when(F.col("background") == F.col("candidates"), S.STAGE_CANCELLED)
        .when(F.col("kept") == 0, S.STAGE_COMPLEXITY)
        .otherwise("")
    )
    rows = [
        ("design_id", F.col("design_id")), ("candidate_kmer_count", F.col("candidates")), ("rejected_interference_background_count", F.col("background")),
        ("rejected_low_complexity_count", F.col("low")), ("locally_filtered_bait_count", F.col("kept")), ("terminal_stage", stage),
    ]
    return long_form(n, rows)


def long_form(df: DataFrame, rows: list[tuple[str, Column]]) -> DataFrame:
    """A row of metrics for each design as ordered (metric, value) rows."""
    items = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(m).alias("metric"), c.cast("string").alias("value")) for i, (m, c) in enumerate(rows)])
    return df.select("design_id", F.explode(items).alias("_m")).select("design_id", "_m.*")
