"""Rows in file order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve.session import settled, small

#: Rows that one chunk of `with_before` holds.
CHUNK = 1 << 16


def in_file_order(scan: DataFrame) -> DataFrame:
    """The rows of a file scan with `file` and `row`, the place in the file from 0.

    Files are read in byte ranges by many tasks. Within a range rows come in order, and their running numbers have no holes;
    so a range needs only its count, and a sum over the ranges of a file gives each its offset.
    """
    raw = scan.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_n"))
    kept = settled(raw)
    ranges = kept.groupBy("file", "_block").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settled(ranges.select("file", "_block", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")))
    return kept.join(small(offsets), ["file", "_block"]).select(*scan.columns, "file", (F.col("_n") + F.col("_shift")).alias("row"))


def with_before(rows: DataFrame, keys: list[str], value: str, into: str = "before", chunk: int = CHUNK) -> DataFrame:
    """Adds `value` of the row before (by `row`, from 0 without holes, within `keys`), null for the first.

    Rows are compared within chunks; the last row of each chunk is handed to the next one by a join.
    """
    at = rows.withColumn("_chunk", F.floor(F.col("row") / chunk))
    inside = at.withColumn("_inside", F.lag(value).over(Window.partitionBy(*keys, "_chunk").orderBy("row")))
    border = rows.where((F.col("row") + 1) % chunk == 0).select(*keys, (F.col("row") + 1).alias("row"), F.col(value).alias("_border"))
    return inside.join(border, [*keys, "row"], "left").withColumn(into, F.coalesce("_inside", "_border")).select(*rows.columns, into)
