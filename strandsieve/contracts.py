"""Contracts of input tables: ordered checks, the first failing row in row order decides the error."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """An input table does not say what it must."""


def error_column(checks: Sequence[tuple[Column, str | Column]]) -> Column:
    """The first message whose condition holds, or null. A null condition does not hold."""
    return F.coalesce(*[F.when(c, m if isinstance(m, Column) else F.lit(m)) for c, m in checks], F.lit(None).cast("string"))


def require(df: DataFrame, checks: Sequence[tuple[Column, str | Column]], order: Sequence[str | Column], what: str) -> DataFrame:
    """Raises on the first bad row by `order`; else returns `df`. One aggregation, at ingestion boundaries only."""
    key = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    found = df.withColumn("_error", error_column(checks)).where("_error is not null").agg(F.min_by("_error", key)).first()[0]
    if found is not None:
        raise ContractError(f"{what}: {found}")
    return df


def order_of(df: DataFrame, *otherwise: str) -> list[str]:
    """The order in which bad rows count: that of the file where rows know their place, else some columns."""
    placed = [c for c in ("design_id", "file", "row") if c in df.columns]
    return placed if "row" in placed else list(otherwise)


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    if list(df.columns) != list(columns):
        raise ContractError(f"{what}: columns are {df.columns}, not {list(columns)}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ContractError(f"{what}: no rows")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    bad = duplicate_keys(df, keys).orderBy(*keys).first()
    if bad is not None:
        raise ContractError(f"{what}: duplicate {', '.join(f'{k}={bad[k]}' for k in keys)}")
    return df


def missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of `left` that `right` lacks."""
    return left.select(*keys).distinct().join(right.select(*keys), list(keys), "left_anti")


def require_present(left: DataFrame, right: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    bad = missing(left, right, keys).orderBy(*keys).first()
    if bad is not None:
        raise ContractError(f"{what}: unknown {', '.join(f'{k}={bad[k]}' for k in keys)}")
    return left


def strict_join(left: DataFrame, right: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """One to one: duplicates and keys without a partner on either side are errors."""
    for side in (left, right):
        require_unique(side, keys, what)
    require_present(left, right, keys, what)
    require_present(right, left, keys, what)
    return left.join(right, list(keys))


def unsorted_rows(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Rows whose `value` is smaller than the row's before it (by `order`, within `keys`)."""
    from pyspark.sql.window import Window

    return df.withColumn("_before", F.lag(value).over(Window.partitionBy(*keys).orderBy(order))).where(F.col(value) < F.col("_before")).drop("_before")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def blank(column: str) -> Column:
    return F.coalesce(F.trim(F.col(column)), F.lit("")) == ""
