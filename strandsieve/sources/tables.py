"""Delimited tables with declared schemas and exact headers, and the design table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandsieve import contracts
from strandsieve import schema as S
from strandsieve.sources.order import in_file_order

# Columns of a design and the forms of their values.
DESIGN = (
    "id", "target_taxid", "curated_source_sequences", "representative_queries", "query_rules", "target_assembly", "background",
    "calibration_reads", "calibration_target_taxids",
)
ID, TAXID, FASTA, TSV = r"^[A-Za-z0-9][A-Za-z0-9._-]*$", r"^[1-9][0-9]*$", r"^\S+\.(fa|fasta|fna)(\.gz)?$", r"^\S+\.tsv$"
DISCOVERY = ("representative_queries", "query_rules", "target_assembly")


def read_table(spark: SparkSession, path: str, schema: str | T.StructType, blanks: bool = True, ordered: bool = False) -> DataFrame:
    """A tab-separated table whose header must be the schema's columns; too many or too few fields are errors.

    `blanks`: empty strings stay empty strings (the reader would make them null). `ordered`: adds `file` and `row`, the row's
    place from 0, so that checks report the first bad row of a file.
    """
    df = spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=False, mode="FAILFAST", quote="\u0000")
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = in_file_order(df) if ordered else df
    return df.fillna("", texts) if blanks and texts else df


def read_bare_table(spark: SparkSession, path: str, schema: str | T.StructType, comment: str = "#") -> DataFrame:
    """A table without header or quotes; lines that start with `comment` are left out, and an empty file is an empty table."""
    return spark.read.csv(path, sep="\t", schema=schema, comment=comment, quote="\u0000", mode="FAILFAST")


def read_kmer_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Two columns without a header, kmer and count as text, with `file` and `row`; `candidates.imported_counts` checks them."""
    return in_file_order(spark.read.csv(path, sep="\t", schema="kmer string, count string", quote="\u0000", mode="FAILFAST"))


def read_exact_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Hits of the panel in the reference, thirteen columns without a header as text, with `file` and `row`."""
    return in_file_order(spark.read.csv(path, sep="\t", schema=", ".join(f"{c} string" for c in S.EXACT_HITS), quote="\u0000", mode="FAILFAST"))


def read_read_hits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Hits of reads, with their exact header; numbers are numbers but scores stay text, and blanks are no nulls."""
    text = ("qseqid", "saccver", "staxids", "bitscore", "stitle")
    real = ("pident", "evalue", "qcovhsp")
    ddl = ", ".join(f"{c} {'string' if c in text else 'double' if c in real else 'long'}" for c in S.READ_HITS)
    return read_table(spark, path, ddl, ordered=True)


def read_status(spark: SparkSession, path: str, metrics: Sequence[str]) -> dict[str, str]:
    """An ordered (metric, value) table as a dictionary; at most a dozen rows."""
    rows = read_table(spark, path, "metric string, value string").collect()
    if [r.metric for r in rows] != list(metrics):
        raise contracts.ContractError(f"{path}: metrics are {[r.metric for r in rows]}")
    return {r.metric: r.value for r in rows}


def read_scope(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "taxid string")


def read_designs(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, header=True)
    for c in DESIGN:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    return check_designs(rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in DESIGN]))


def direct_design(spark: SparkSession, **values: str) -> DataFrame:
    """One design from parameters; without an id it is named by its source file."""
    given = {c: values.get(c) or "" for c in DESIGN}
    if not given["id"]:
        given["id"] = re.sub(r"\.(fa|fasta|fna)(\.gz)?$", "", given["curated_source_sequences"].rsplit("/", 1)[-1])
    return check_designs(spark.createDataFrame([tuple(given.values())], ", ".join(f"{c} string" for c in DESIGN)))


def check_designs(designs: DataFrame) -> DataFrame:
    """Forms of the values; curated sources or all three discovery columns, not both; a scope only with reads; unique ids."""
    contracts.require_rows(designs, "designs")
    curated, found = ~contracts.blank("curated_source_sequences"), [~contracts.blank(c) for c in DISCOVERY]
    file = lambda c, form: (~contracts.blank(c) & ~F.col(c).rlike(form), F.concat(F.lit(f"{c} is no such file: "), F.col(c)))
    checks = [
        (~F.col("id").rlike(ID), F.concat(F.lit("malformed id "), F.col("id"))),
        (~F.col("target_taxid").rlike(TAXID), F.concat(F.lit("malformed target_taxid for "), F.col("id"))),
        (contracts.blank("background"), F.concat(F.lit("no background for "), F.col("id"))),
        (curated & contracts.any_of(found), F.concat(F.lit("both curated and discovery inputs for "), F.col("id"))),
        (~curated & ~(found[0] & found[1] & found[2]), F.concat(F.lit("incomplete discovery inputs for "), F.col("id"))),
        (contracts.blank("calibration_reads") & ~contracts.blank("calibration_target_taxids"), F.concat(F.lit("a scope without reads for "), F.col("id"))),
        (F.col("calibration_reads").rlike(r"[*?\[\]{}]"), F.concat(F.lit("calibration_reads must be a plain directory for "), F.col("id"))),
        *[file(c, FASTA) for c in ("curated_source_sequences", "representative_queries", "target_assembly", "background")],
        *[file(c, TSV) for c in ("query_rules", "calibration_target_taxids")],
    ]
    contracts.require(designs, checks, ["id"], "designs")
    return contracts.require_unique(designs, ["id"], "designs")


def check_run(designs: DataFrame, reference: str | None) -> None:
    """Reads are classified against the taxonomic reference, so they need one."""
    if reference is None:
        contracts.require(designs, [(~contracts.blank("calibration_reads"), F.concat(F.lit("reads without a taxonomic reference for "), F.col("id")))], ["id"], "designs")


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """The taxonomic reference as a Parquet table (saccver, staxids, sscinames, stitle, sequence), pruned at the scan."""
    return spark.read.parquet(path).select("saccver", "staxids", "sscinames", "stitle", "sequence")


def reference_report(reference: DataFrame) -> DataFrame:
    """Number of records and of bases."""
    return reference.agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("sequence")).alias("bases"))
