"""Taxonomic screening: every exact match of every k-mer of the panel, and what it means for it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.functions import packed
from strandsieve.functions.sequence import canonical, is_dna, normalize, reverse_complement, tiles, windows
from strandsieve.functions.taxonomy import only_target
from strandsieve.operators.candidates import long_form

#: K-mers that may be broadcast against the reference; beyond that the join is shuffled.
BROADCAST_KMERS = 400_000


def exact_match_hits(members: DataFrame, reference: DataFrame, k: int, broadcast: bool | None = None) -> DataFrame:
    """All full-length ungapped matches of `members` (design_id, bait_id, sequence) on both strands of `reference`.

    `reference` has saccver, staxids, sscinames, stitle and sequence, shared by all designs. Nothing is cut off: there is
    no limit of subjects or of expected value. A match on the minus strand has sstart > send; a palindromic k-mer matches a
    place on either strand, one row each.
    """
    if broadcast is None:
        broadcast = members.limit(BROADCAST_KMERS + 1).count() <= BROADCAST_KMERS
    info = ("saccver", "staxids", "sscinames", "stitle")
    wanted = members.select("design_id", F.col("bait_id").alias("qseqid"), F.col("sequence").alias("_member"), canonical(F.col("sequence")).alias("_key"))
    strand = lambda own, other: F.array_compact(F.array(F.when(own, F.lit("plus")), F.when(other, F.lit("minus"))))
    if k <= packed.MOST:
        # Codes, places and strands alone go through the join; a k-mer as it is stored is its canonical form or the reverse of it.
        wanted = wanted.select("design_id", "qseqid", packed.pack(F.col("_key")).alias("_code"), (F.col("_member") == F.col("_key")).alias("_same"))
        # Windows that no member has are left out where they are cut, before the texts beside them are copied.
        only = packed.wanted(wanted.select(F.col("_code").alias("code")))
        tile = packed.coded(reference, k, info, lenient=True, only=only).select(*info, F.explode(F.arrays_zip("starts", "codes", "strands")).alias("_w"))
        placed = tile.select(*info, (F.col("_w.starts") + 1).alias("_first"), F.col("_w.codes").alias("_code"), F.col("_w.strands").alias("_s"))
        met = placed.join(F.broadcast(wanted) if broadcast else wanted, "_code")
        strands = strand((F.col("_s") == 3) | ((F.col("_s") == 1) == F.col("_same")), (F.col("_s") == 3) | ((F.col("_s") == 2) == F.col("_same")))
    else:
        size = 1 << 16
        piece = reference.select(*info, F.posexplode(tiles(normalize(F.col("sequence")), k, size)).alias("_tile", "_piece"))
        placed = piece.select(*info, "_tile", F.posexplode(windows(F.col("_piece"), k)).alias("_at", "_window")).where(is_dna(F.col("_window")))
        placed = placed.select(*info, (F.col("_tile").cast("long") * size + F.col("_at") + 1).alias("_first"), "_window", canonical(F.col("_window")).alias("_key"))
        met = placed.join(F.broadcast(wanted) if broadcast else wanted, "_key")
        strands = strand(F.col("_window") == F.col("_member"), reverse_complement(F.col("_window")) == F.col("_member"))
    last = F.col("_first") + (k - 1)
    one = lambda n: F.lit(n).cast("long")
    return met.withColumn("_strand", F.explode(strands)).select(
        "design_id", "qseqid", "saccver", "staxids", "sscinames", F.lit(100.0).alias("pident"), one(k).alias("length"), one(0).alias("mismatch"),
        one(0).alias("gapopen"), one(1).alias("qstart"), one(k).alias("qend"), F.when(F.col("_strand") == "plus", F.col("_first")).otherwise(last).alias("sstart"),
        F.when(F.col("_strand") == "plus", last).otherwise(F.col("_first")).alias("send"), "stitle",
    )


def typed_hits(raw: DataFrame) -> DataFrame:
    """Imported hits as text to numbers; what is no number becomes null and fails `check_hits`."""
    numbers = ("length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send")
    whole = {c: F.when(F.col(c).rlike("^[0-9]+$"), F.col(c).try_cast("long")) for c in numbers}
    return raw.withColumns({**whole, "pident": F.col("pident").try_cast("double")})


def exact_geometry(k: int) -> F.Column:
    """The hit covers the whole k-mer without mismatch or gap."""
    return (
        (F.col("pident") == 100) & (F.col("length") == k) & (F.col("mismatch") == 0) & (F.col("gapopen") == 0) & (F.col("qstart") == 1)
        & (F.col("qend") == k) & (F.col("sstart") >= 1) & (F.col("send") >= 1) & (F.abs(F.col("send") - F.col("sstart")) + 1 == k)
    )


def check_hits(hits: DataFrame, members: DataFrame, k: int) -> DataFrame:
    known = members.select("design_id", F.col("bait_id").alias("qseqid"))
    checks = [
        (contracts.any_of([F.col(c).isNull() for c in S.EXACT_HITS]), "missing field"),
        (~F.col("staxids").rlike(r"^([1-9][0-9]*|N/A)(;([1-9][0-9]*|N/A))*$"), F.concat(F.lit("malformed taxa for "), F.col("qseqid"))),
        (~exact_geometry(k), F.concat(F.lit("not an exact full-length match: "), F.col("qseqid"))),
    ]
    contracts.require(hits, checks, contracts.order_of(hits, "design_id", "qseqid", "saccver"), "exact matches")
    contracts.require_present(hits, known, ["design_id", "qseqid"], "exact matches")
    return hits


def screening_decisions(members: DataFrame, hits: DataFrame, targets: DataFrame) -> DataFrame:
    """Per k-mer of the panel the hit rows on and off target; any off-target row rejects, no hits pass with 0 and 0."""
    judged = hits.join(targets.select("design_id", "target_taxid"), "design_id").withColumn("_on", only_target(F.col("staxids"), F.col("target_taxid")))
    counts = judged.groupBy("design_id", F.col("qseqid").alias("bait_id")).agg(F.count_if(F.col("_on")).alias("on_target_hits"), F.count_if(~F.col("_on")).alias("off_target_hits"))
    joined = members.select("design_id", "bait_id").join(counts, ["design_id", "bait_id"], "left").fillna(0, ["on_target_hits", "off_target_hits"])
    status = F.when(F.col("off_target_hits") > 0, S.REJECT_OFF_TARGET).otherwise(S.PASS)
    return joined.withColumn("taxonomic_screening_status", status).select("design_id", *S.SCREENING_DECISIONS)


def apply_screening(manifest: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions taken over into the manifest; rows without a decision keep their state."""
    d = decisions.select("design_id", "bait_id", F.col("taxonomic_screening_status").alias("_status"), F.col("on_target_hits").alias("_on"), F.col("off_target_hits").alias("_off"))
    joined = manifest.join(d, ["design_id", "bait_id"], "left")
    rejected = F.col("_status") == S.REJECT_OFF_TARGET
    return joined.withColumns({
        "status": F.when(rejected, S.REJECT_OFF_TARGET).otherwise(F.col("status")),
        "rejection_reason": F.when(rejected, S.OFF_TARGET_MATCH).otherwise(F.col("rejection_reason")),
        "taxonomic_screening_status": F.coalesce("_status", "taxonomic_screening_status"),
        "on_target_hits": F.coalesce("_on", "on_target_hits"),
        "off_target_hits": F.coalesce("_off", "off_target_hits"),
    }).select("design_id", *S.MANIFEST)


def screening_status(manifest: DataFrame, decisions: DataFrame, designs: DataFrame) -> DataFrame:
    """Local and screened panel sizes of each design, and whether screening left anything."""
    local = manifest.where("bait_id <> ''").groupBy("design_id").agg(F.count(F.lit(1)).alias("local"))
    left = decisions.groupBy("design_id").agg(F.count_if(F.col("taxonomic_screening_status") == S.PASS).alias("screened"))
    n = designs.select("design_id").distinct().join(local, "design_id", "left").join(left, "design_id", "left").fillna(0)
    rows = [
        ("design_id", F.col("design_id")), ("locally_filtered_bait_count", F.col("local")),
        ("taxonomic_screening_status", F.when(F.col("screened") > 0, S.PASS).otherwise(S.STAGE_EMPTY_PANEL)), ("taxonomically_screened_bait_count", F.col("screened")),
    ]
    return long_form(n, rows)


def set_status(manifest: DataFrame, designs: DataFrame, screened: bool) -> DataFrame:
    """Eight ordered metrics of each design's panel; `designs` has design_id and source_sequence_origin.

    The index is built from the deepest panel; without one its source is blank.
    """
    n = manifest.groupBy("design_id").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("bait_id") != "").alias("local"), F.count_if((F.col("status") == S.PASS) & (F.col("bait_id") != "")).alias("kept"),
        F.count_if(F.col("status") == S.REJECT_BACKGROUND).alias("background"), F.count_if(F.col("status") == S.REJECT_COMPLEXITY).alias("low"),
    )
    n = designs.select("design_id", "source_sequence_origin").join(n, "design_id", "left").fillna(0, ["candidates", "local", "kept", "background", "low"])
    ran = F.lit(screened) & (F.col("local") > 0)
    deepest = F.when(ran & (F.col("kept") > 0), "taxonomically_screened").otherwise("locally_filtered")
    rows = [
        ("design_id", F.col("design_id")), ("source_sequence_origin", F.col("source_sequence_origin")), ("candidate_kmer_count", F.col("candidates")),
        ("locally_filtered_bait_count", F.col("local")),
        ("taxonomic_screening_status", F.when(ran, F.when(F.col("kept") > 0, S.PASS).otherwise(S.STAGE_EMPTY_PANEL)).otherwise(S.NOT_RUN)),
        ("taxonomically_screened_bait_count", F.when(ran, F.col("kept").cast("string")).otherwise("")),
        ("deepest_bait_set", deepest), ("deacon_index_source", F.when(F.col("kept") > 0, deepest).otherwise("")),
    ]
    return long_form(n, rows)


