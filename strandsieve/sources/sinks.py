"""Results: Parquet by design as the engine's own form, TSV and FASTA as exports, in a layout by stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Published stages in order.
STAGES = {
    "sources": "01_source_sequences", "candidates": "02_candidate_kmers", "screening": "03_taxonomic_screening", "panel": "04_bait_sets",
    "index": "05_index", "calibration": "06_calibration", "provenance": "07_provenance",
}


def write_table(df: DataFrame, root: str, stage: str, name: str) -> str:
    """The engine's own form: Parquet in a folder for each design, so that one design is read alone."""
    path = f"{root}/{STAGES[stage]}/{name}"
    df.write.mode("overwrite").partitionBy("design_id").parquet(path)
    return path


def write_tsv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """One unquoted file with a header even without rows; null and blank are both blank."""
    df = df.orderBy(*order) if order else df
    df = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
    df.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, quote="\u0000", escape="\u0000", emptyValue="", nullValue="")


def write_fasta(df: DataFrame, path: str, name: str = "id", sequence: str = "sequence", wrap: int | None = 60, order: list[str] | None = None) -> None:
    """Records as text, wrapped or on one line each."""
    df.orderBy(*(order or [name])).select(fasta_record(F.col(name), F.col(sequence), wrap)).coalesce(1).write.mode("overwrite").text(path)


def fasta_record(name: Column, sequence: Column, wrap: int | None = 60) -> Column:
    body = F.regexp_replace(sequence, f"(.{{{wrap}}})(?=.)", "$1\n") if wrap else sequence
    return F.concat(F.lit(">"), name, F.lit("\n"), body).alias("value")


def write_if_any(df: DataFrame, path: str, write) -> bool:
    """Writes only what has rows, and removes what an earlier run left; tells whether it wrote."""
    if not df.isEmpty():
        write(df, path)
        return True
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return False


def deepest_manifest(local: DataFrame, screened: DataFrame | None) -> tuple[str, DataFrame]:
    """The manifest is published once: after screening if that runs, else after filtering."""
    return ("candidates", local) if screened is None else ("screening", screened)
