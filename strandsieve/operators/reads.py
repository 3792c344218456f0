"""Calibration reads: names of sources, panel counts, identities and the queries to be aligned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.functions.ranking import numbered_by
from strandsieve.functions.sequence import canonical, representative_id
from strandsieve.operators.panel import matching_records
from strandsieve.session import settled, small

# Fixed value: the form of a name that is safe as an id.
SAFE_ID = "^[A-Za-z0-9][A-Za-z0-9._-]*$"


def accepted_reads(names: DataFrame) -> DataFrame:
    return names.where(F.col("name").rlike(r"\.(fastq|fq)(\.gz)?$"))


def resolve_read_sources(names: DataFrame) -> DataFrame:
    """id, design_id, metagenome_id and read for each file name (design_id, name) with an accepted suffix.

    The stem is the id; where stems collide the full name is; what is unsafe or still collides is named by its hash.
    """
    stem = F.regexp_replace("name", r"\.(fastq|fq)(\.gz)?$", "")
    rows = accepted_reads(names).withColumn("_stem", stem)
    count = lambda c: F.count(F.lit(1)).over(Window.partitionBy("design_id", c))
    rows = rows.withColumn("_first", F.when(count("_stem") == 1, F.col("_stem")).otherwise(F.col("name")))
    safe = (count("_first") == 1) & F.col("_first").rlike(SAFE_ID)
    named = rows.withColumn("metagenome_id", F.when(safe, F.col("_first")).otherwise(F.concat(F.lit("read_"), F.sha2("name", 256))))
    return named.select(F.concat_ws("__", "design_id", "metagenome_id").alias("id"), "design_id", "metagenome_id", F.col("name").alias("read"))


def count_panel_kmers(reads: DataFrame, panel: DataFrame, k: int) -> DataFrame:
    """Reads that match the panel: their distinct k-mers of it, their number in file order, and their representative.

    `reads` has design_id, metagenome_id, ordinal (the place in its file: a read's identity) and sequence.
    """
    keys = ("metagenome_id", "ordinal")
    counts = matching_records(reads, panel, k, keys)
    joined = reads.join(counts, ["design_id", *keys]).select("design_id", *keys, "sequence", "bait_count")
    return numbered_by(joined, ["design_id", "metagenome_id"], ["ordinal"], "_number").select(
        "design_id", "metagenome_id", F.format_string("read_%012d", F.col("_number")).alias("read_id"), F.length("sequence").cast("long").alias("read_length"),
        "bait_count", representative_id(F.col("sequence")).alias("representative_id"), F.col("sequence"), "ordinal",
    )


def read_queries(counted: DataFrame) -> DataFrame:
    """One query for each representative: the canonical sequence under its id."""
    return counted.groupBy("design_id", "representative_id").agg(F.min(canonical(F.upper("sequence"))).alias("sequence"))


def preparation_summary(counted: DataFrame, returned: DataFrame, designs: DataFrame) -> DataFrame:
    """Returned reads (design_id, returned), candidates, duplicates by sequence, and queries, for each design."""
    n = counted.groupBy("design_id").agg(F.count(F.lit(1)).alias("candidate_read_count"), F.count_distinct("representative_id").alias("read_blast_query_count"))
    back = returned.groupBy("design_id").agg(F.sum("returned").alias("deacon_returned_read_count"))
    joined = designs.select("design_id").distinct().join(n, "design_id", "left").join(back, "design_id", "left").fillna(0)
    joined = joined.withColumn("duplicate_sequence_count", F.col("candidate_read_count") - F.col("read_blast_query_count"))
    return joined.select(*S.PREPARATION)


def shard_queries(queries: DataFrame, shards: int = S.Defaults.shards) -> DataFrame:
    """Adds `shard` from 0 to shards-1, by hash; a shard is a unit of alignment work."""
    return queries.withColumn("shard", F.pmod(F.xxhash64("design_id", "representative_id"), F.lit(shards)).cast("int"))


def gather_shards(parts: list[DataFrame], parameters: list[dict[str, str]]) -> tuple[DataFrame, dict[str, str]]:
    """All shards' hits as one table; headers and parameters must agree. Adds the number of shards to the parameters."""
    if not parts or any(p.columns != parts[0].columns for p in parts):
        raise contracts.ContractError("read hits: shards have different columns")
    if any(p != parameters[0] for p in parameters):
        raise contracts.ContractError("read hits: shards were searched with different parameters")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, {**parameters[0], "query_file_count": str(len(parts))}


def check_counts(counts: DataFrame) -> DataFrame:
    checks = [
        (contracts.blank("metagenome_id"), "blank metagenome_id"),
        (~F.col("read_id").rlike("^read_[0-9]{12}$"), F.concat(F.lit("malformed read_id "), F.col("read_id"))),
        (~F.coalesce((F.col("read_length") > 0) & (F.col("bait_count") > 0), F.lit(False)), F.concat(F.lit("count is not positive for "), F.col("read_id"))),
        (~F.col("representative_id").rlike("^sequence_[0-9a-f]{64}$"), F.concat(F.lit("malformed representative for "), F.col("read_id"))),
    ]
    contracts.require(counts, checks, ["design_id", "metagenome_id", "read_id"], "read counts")
    return contracts.require_unique(counts, ["design_id", "metagenome_id", "read_id"], "read counts")


# Metrics of a source's status, in order, and the form of a representative.
READ_STATUS = ("metagenome_id", "deacon_returned_read_count", "candidate_read_count")
_NUMBER, _REPRESENTATIVE = "^[0-9]+$", "^sequence_[0-9a-f]{64}$"


def read_statuses(status: DataFrame) -> DataFrame:
    """A row for each (design_id, source) of its (ordinal, metric, value) status, if that is well formed."""
    listed = status.groupBy("design_id", "source").agg(F.array_sort(F.collect_list(F.struct("ordinal", "metric", F.coalesce("value", F.lit("")).alias("value")))).alias("m"))
    say = lambda text: F.concat(F.lit(f"{text} "), F.col("source"))
    names = F.transform("m", lambda x: x["metric"])
    contracts.require(listed, [(names != F.array(*map(F.lit, READ_STATUS)), say("malformed status of"))], ["design_id", "source"], "read status")
    wide = listed.select("design_id", "source", *[F.col("m")[i]["value"].alias(n) for i, n in enumerate(READ_STATUS)])
    numbers = contracts.any_of([~F.col(n).rlike(_NUMBER) | F.col(n).try_cast("long").isNull() for n in READ_STATUS[1:]])
    checks = [((F.col("metagenome_id") == "") | numbers, say("malformed status of")), (F.col(READ_STATUS[1]).try_cast("long") != F.col(READ_STATUS[2]).try_cast("long"), say("returned and candidate counts disagree in"))]
    contracts.require(wide, checks, ["design_id", "source"], "read status")
    contracts.require_unique(wide, ["design_id", "metagenome_id"], "read status")
    return wide.select("design_id", "source", "metagenome_id", *[F.col(n).cast("long").alias(n) for n in READ_STATUS[1:]])


def combine_counts(counts: DataFrame, sources: DataFrame, status: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All sources' counts of a design as one table with `ordinal` in order of source names, and its preparation summary.

    `counts` has design_id, source, row (place in its file) and the columns of read counts as text; `sources` names the count
    files (design_id, source), also those without rows; `status` is as `read_statuses` gives it; `queries` has design_id and
    representative_id. Sources, numbers of rows, names and representatives must agree on all sides.
    """
    both = ["design_id", "source"]
    contracts.require_present(sources, status, both, "read counts (no status)")
    contracts.require_present(status, sources, both, "read counts (no counts)")
    rows = settled(counts.join(small(settled(status.select(*both, F.col("metagenome_id").alias("_named")))), both, "left"))
    whole = lambda c: F.coalesce(F.col(c).rlike(_NUMBER) & (F.col(c).try_cast("long") > 0), F.lit(False))
    valid = (
        F.col("metagenome_id").eqNullSafe(F.col("_named")) & F.col("read_id").eqNullSafe(F.format_string("read_%012d", F.col("row") + 1)) & whole("read_length") & whole("bait_count")
        & F.coalesce(F.col("representative_id").rlike(_REPRESENTATIVE), F.lit(False))
    )
    contracts.require(rows, [(~valid, F.concat(F.lit("malformed row of "), F.col("source")))], [*both, "row"], "read counts")
    n = status.join(rows.groupBy(*both).agg(F.count(F.lit(1)).alias("_rows")), both, "left").fillna(0, ["_rows"])
    contracts.require(n, [(F.col("_rows") != F.col("candidate_read_count"), F.concat(F.lit("rows and status disagree in "), F.col("source")))], both, "read counts")
    key = ["design_id", "representative_id"]
    contracts.require_present(rows, queries, key, "read queries (missing)")
    contracts.require_present(queries, rows, key, "read queries (without a read)")
    typed = rows.select(*both, "row", "metagenome_id", "read_id", *[F.col(c).cast("long").alias(c) for c in ("read_length", "bait_count")], "representative_id")
    combined = settled(numbered_by(typed, ["design_id"], ["source", "row"], "ordinal"))
    returned = status.select("design_id", F.col("deacon_returned_read_count").alias("returned"))
    return combined.select("design_id", *S.READ_COUNTS, "ordinal"), preparation_summary(combined, returned, status.select("design_id"))
