"""Row numbers in a total order without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandsieve.session import settled, small


def numbered(df: DataFrame, keys: list[str], order: str, into: str, tie: list[Column] | None = None, prefix: int = 5) -> DataFrame:
    """Adds `into`: 1, 2, ... within `keys` by the string column `order` (then `tie`).

    Rows are grouped by the first characters of `order`; a small table of group sizes gives each group its offset, and
    each group is numbered by itself. `df` is read twice, so it should be cheap to read again. With bases and five characters there are up to 1,024 groups for each key.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.col(order), 1, prefix))
    sizes = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bucket").alias("_b"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(F.col(order), *(tie or []))
    match = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(keys):
        match &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = bucketed.withColumn("_at", F.row_number().over(within)).join(offsets, match)
    return out.withColumn(into, F.col("_offset") + F.col("_at")).select(*[c for c in df.columns if c != into], into)


def numbered_by(df: DataFrame, keys: list[str], order: list[str], into: str) -> DataFrame:
    """Adds `into`: 1, 2, ... within `keys` by any columns of `order`, ascending.

    Rows are dealt by range of keys and order and sorted where they lie; a task's rows of a key are neighbours, so their number is
    that of the rows of the key in the ranges before, plus their place in their own.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order).withColumn("_n", F.monotonically_increasing_id())
    kept = settled(placed).withColumn("_part", F.shiftright("_n", 33))
    parts = kept.groupBy(*keys, "_part").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settled(parts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")))
    match = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        match &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return kept.join(small(offsets), match).withColumn(into, F.col("_n") + F.col("_shift")).select(*[c for c in df.columns if c != into], into)
