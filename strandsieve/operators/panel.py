"""The operational index: built, read back, used as a filter, and verified against the manifest and the background."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.functions import packed
from strandsieve.functions.sequence import canonical, normalize
from strandsieve.operators.candidates import background_counts, enumerate_kmers, long_form, panel_of

BROADCAST_KMERS = 400_000


def build_index(panel: DataFrame, path: str, k: int, window: int = S.Defaults.window) -> None:
    """Writes the panel's canonical k-mers as a table sorted by k-mer, a folder for each design."""
    if window != 1:
        raise ValueError("only window 1, where every k-mer is indexed, is defined")
    keyed = panel.select("design_id", canonical(F.col("sequence")).alias("kmer"), F.lit(k).alias("k")).distinct()
    n = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed.repartitionByRange(n, "design_id", "kmer").sortWithinPartitions("design_id", "kmer").write.mode("overwrite").partitionBy("design_id").parquet(path)


def read_index(spark, path: str) -> DataFrame:
    return spark.read.schema("kmer string, k int, design_id string").parquet(path).select("design_id", "kmer", "k")


def matching_records(records: DataFrame, panel: DataFrame, k: int, keys: tuple[str, ...], least: int = 1) -> DataFrame:
    """`keys` and bait_count (distinct k-mers of the panel) of each record that has at least `least` of them.

    `records` has design_id, `keys` and sequence; `panel` has design_id and sequence.
    """
    cleaned = records.select("design_id", *keys, normalize(F.col("sequence")).alias("sequence"))
    wanted = panel.select("design_id", canonical(F.col("sequence")).alias("kmer")).distinct()
    small = wanted.limit(BROADCAST_KMERS + 1).count() <= BROADCAST_KMERS
    if k <= packed.MOST:
        wanted = wanted.select("design_id", packed.pack(F.col("kmer")).alias("kmer"))
        only = packed.wanted(wanted.select(F.col("kmer").alias("code")))
        found = packed.code_rows(records, k, ("design_id", *keys), lenient=True, only=only).withColumnRenamed("code", "kmer")
    else:
        found = enumerate_kmers(cleaned, k, ("design_id", *keys)).select("design_id", *keys, "kmer")
    hits = found.join(F.broadcast(wanted) if small else wanted, ["design_id", "kmer"], "left_semi")
    return hits.groupBy("design_id", *keys).agg(F.size(F.collect_set("kmer")).cast("long").alias("bait_count")).where(F.col("bait_count") >= least)


def filter_records(records: DataFrame, panel: DataFrame, k: int, keys: tuple[str, ...]) -> DataFrame:
    """The records with at least one k-mer of the panel."""
    return records.join(matching_records(records, panel, k, keys).select("design_id", *keys), ["design_id", *keys], "left_semi")


def deepest_panel(local: DataFrame, screened: DataFrame | None) -> DataFrame:
    """The screened panel if screening was asked for (it may be empty), else the local one."""
    return local if screened is None else screened


def index_errors(manifest: DataFrame, panel: DataFrame, index: DataFrame, background: DataFrame, k: int) -> DataFrame:
    """Rows (design_id, error, value) for everything in which manifest, panel, index and background disagree; empty if sound."""
    passed = panel_of(manifest)
    same = ["design_id", "bait_id", "sequence"]
    key = panel.select("design_id", canonical(F.col("sequence")).alias("kmer"))
    back = index.select("design_id", "kmer")
    marked = lambda df, error, value: df.select("design_id", F.lit(error).alias("error"), F.col(value).alias("value"))
    in_background = background_counts(back.distinct(), background, k)
    return (
        marked(passed.join(panel, same, "left_anti"), "manifest_only", "bait_id")
        .unionByName(marked(panel.join(passed, same, "left_anti"), "panel_only", "bait_id"))
        .unionByName(marked(key.join(back, ["design_id", "kmer"], "left_anti"), "panel_not_indexed", "kmer"))
        .unionByName(marked(back.join(key, ["design_id", "kmer"], "left_anti"), "indexed_not_in_panel", "kmer"))
        .unionByName(marked(back.join(in_background, ["design_id", "kmer"], "left_semi"), "background_match", "kmer"))
    )


class VerificationError(contracts.ContractError):
    """The index does not reproduce the panel, or matches the background."""


#: What the verified index is said to be, and the digest of a round trip that returns nothing.
CONCLUSION = "The Deacon index reproduces the bait set and retains no interference background records."
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def kmer_digest(kmers: DataFrame) -> DataFrame:
    """design_id, n and sha256 of each design's k-mers: of the digests, in order, of the sorted k-mers by their first five bases."""
    head = F.substring("kmer", 1, 5).alias("_head")
    parts = kmers.groupBy("design_id", head).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("kmer")), "\n"), 256).alias("part"))
    joined = F.transform(F.array_sort(F.collect_list(F.struct("_head", "part"))), lambda x: x["part"])
    return parts.groupBy("design_id").agg(F.sum("n").alias("n"), F.sha2(F.array_join(joined, "\n"), 256).alias("sha256"))


def verification_summary(index: DataFrame, errors: DataFrame, k: int, window: int = S.Defaults.window) -> DataFrame:
    """Twelve ordered metrics of each design that has an index (`index` as read back, with the errors found in it)."""
    back = kmer_digest(index.select("design_id", "kmer"))
    met = errors.where("error = 'background_match'").select("design_id", F.col("value").alias("kmer"))
    held = kmer_digest(met).select("design_id", F.col("n").alias("held"), F.col("sha256").alias("held_sha256"))
    kinds = errors.groupBy("design_id").agg(F.count_if(F.col("error") != "background_match").alias("differences"))
    n = back.join(held, "design_id", "left").join(kinds, "design_id", "left").fillna(0, ["held", "differences"]).fillna(EMPTY_SHA256, ["held_sha256"])
    equal = F.col("differences") == 0
    rows = [
        ("design_id", F.col("design_id")), ("kmer_size", F.lit(k)), ("deacon_window", F.lit(window)), ("deacon_index_entropy_threshold", F.lit("0")),
        ("deacon_filter_absolute_threshold", F.lit("1")), ("deacon_filter_relative_threshold", F.lit("0")), ("bait_roundtrip_record_count", F.col("n")),
        ("bait_roundtrip_sha256", F.col("sha256")), ("bait_sequence_sets_equal", F.when(equal, "true").otherwise("false")),
        ("interference_background_roundtrip_record_count", F.col("held")), ("interference_background_roundtrip_sha256", F.col("held_sha256")),
        ("conclusion", F.when(equal & (F.col("held") == 0), CONCLUSION).otherwise("")),
    ]
    return long_form(n, rows)


def verify(errors: DataFrame) -> None:
    bad = errors.first()
    if bad is not None:
        raise VerificationError(f"{bad.design_id}: {bad.error} {bad.value}")


def report(summary: DataFrame) -> str:
    """The summary as a Markdown document, a section for each design."""
    lines: list[str] = []
    design = None
    for r in summary.orderBy("design_id", "ordinal").collect():
        if r.design_id != design:
            design = r.design_id
            lines += [f"# Index verification: {design}", "", "| metric | value |", "| --- | --- |"]
        lines.append(f"| {r.metric} | {r.value} |")
        if r.metric == "conclusion":
            lines.append("")
    return "\n".join(lines)
