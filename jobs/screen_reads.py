"""Screens arriving reads against the panels: which reads carry k-mers of which design's panel, and how many.

    python jobs/screen_reads.py --config jobs/screen_reads.toml [--reads PATH ...]

Reads arrive as Parquet files in a folder, or under a pattern of paths (the documents table; a read is a row). A file stream takes the files that its
checkpoint has not seen, all that are there, and ends. For each micro-batch two tables are written, partitioned by batch and
design:

- `counts`: design_id, metagenome_id, ordinal, read_length, bait_count, representative_id of each read that matches;
- `seen`: design_id, metagenome_id, reads, bases, matching_reads and matching_bases of all reads of the batch.

Each batch writes its own partitions, by dynamic overwrite: a batch that is repeated after a failure replaces what it wrote,
and nothing else. A run without new files writes nothing. A file counts once, by its path; what a file held is not taken
again if the file is changed. The panel is a table of (design_id, sequence); designs that have no panel match nothing.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import log, prepared, session, settings, table_or_none
from strandsieve.functions.sequence import representative_id
from strandsieve.operators.panel import matching_records
from strandsieve.plans.suite import reads_of
from strandsieve.session import settled, small

SETTINGS = {"reads": str, "panel": str, "output": str, "checkpoint": str, "kmer_size": int, "least": int, "batch_files": int}
ARRIVING = "doc_id long, text string"
COUNTS = "metagenome_id string, ordinal long, read_length long, bait_count long, representative_id string, batch long, design_id string"
SEEN = "metagenome_id string, reads long, bases long, matching_reads long, matching_bases long, batch long, design_id string"


@dataclass
class Report:
    """What a run read and wrote."""

    batches: list[int] = field(default_factory=list)
    read: int = 0
    matching: int = 0


def screen_reads(spark: SparkSession, reads: str, panel: str, output: str, checkpoint: str, kmer_size: int = 15, least: int = 1, batch_files: int = 1000) -> Report:
    """Takes what is new in `reads`, and returns when it is written."""
    with prepared(spark):
        return _screen(spark, reads, panel, output, checkpoint, kmer_size, least, batch_files)


def _screen(spark: SparkSession, reads: str, panel: str, output: str, checkpoint: str, kmer_size: int, least: int, batch_files: int) -> Report:
    members = spark.read.parquet(panel).select("design_id", "sequence")
    report = Report()

    def screen(batch: DataFrame, number: int) -> None:
        arrived = reads_of(batch)
        # Counted once, then used by both tables.
        counts = settled(matching_records(arrived, members, kmer_size, ("metagenome_id", "ordinal"), least))
        keys = ["design_id", "metagenome_id", "ordinal"]
        matched = arrived.join(small(counts), keys).select(
            *keys[1:], F.length("sequence").cast("long").alias("read_length"), "bait_count", representative_id(F.col("sequence")).alias("representative_id"), F.lit(number).cast("long").alias("batch"), "design_id"
        )
        whole = arrived.groupBy("design_id", "metagenome_id").agg(F.count(F.lit(1)).alias("reads"), F.sum(F.length("sequence").cast("long")).alias("bases"))
        _write(matched, f"{output}/counts")
        written = spark.read.schema(COUNTS).parquet(f"{output}/counts").where(F.col("batch") == number)
        some = written.groupBy("design_id", "metagenome_id").agg(F.count(F.lit(1)).alias("matching_reads"), F.sum("read_length").alias("matching_bases"))
        seen = whole.join(some, ["design_id", "metagenome_id"], "left").fillna(0).withColumn("batch", F.lit(number).cast("long"))
        _write(seen.select(*[c.split()[0] for c in SEEN.split(", ")]), f"{output}/seen")
        n = spark.read.schema(SEEN).parquet(f"{output}/seen").where(F.col("batch") == number).agg(F.sum("reads"), F.sum("matching_reads")).first()
        report.batches.append(number)
        report.read += n[0] or 0
        report.matching += n[1] or 0
        log.info("batch %d: read %d reads, wrote %d that match", number, n[0] or 0, n[1] or 0)

    arriving = spark.readStream.schema(ARRIVING).option("maxFilesPerTrigger", batch_files).parquet(reads)
    query = arriving.writeStream.foreachBatch(screen).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    log.info("%s: %d batches, %d reads read, %d of them match; tables in %s", reads, len(report.batches), report.read, report.matching, output)
    return report


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "design_id").parquet(path)


def screened(spark: SparkSession, output: str) -> DataFrame:
    """All reads that matched so far, whichever batch brought them."""
    found = table_or_none(spark, f"{output}/counts", COUNTS)
    return (found if found is not None else spark.createDataFrame([], COUNTS)).select("design_id", "metagenome_id", "ordinal", "read_length", "bait_count", "representative_id")


def main(argv: list[str] | None = None) -> None:
    values = settings(argv, "screen_reads.toml", SETTINGS)
    spark = session("screen-reads")
    try:
        screen_reads(spark, **values)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
