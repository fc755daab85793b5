"""Grouped aggregates. All are built-in, so Spark reduces each partition before the shuffle (partial + final)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.changelog import DELETE, INSERT


def group_sum(df: DataFrame, keys: Sequence[str], value: str | Column, name: str) -> DataFrame:
    """Sum per key; on a stream use update or complete mode."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def group_aggregate(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs)


def signed(value: str | Column, op: str = "_op") -> Column:
    """The value for an inserted row, its negative for a removed one."""
    column = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(op) == INSERT, column).otherwise(-column)


def retractable(changes: DataFrame, keys: Sequence[str], op: str = "_op", **sums: str | Column) -> DataFrame:
    """Sums over the rows that a changelog leaves; a removed row is subtracted and an empty key disappears."""
    rows = F.sum(signed(F.lit(1).cast("long"), op)).alias("_rows")
    totals = [F.sum(signed(column, op)).alias(name) for name, column in sums.items()]
    return changes.groupBy(*keys).agg(rows, *totals).where("_rows > 0").drop("_rows")


def retracting(changes: DataFrame, keys: Sequence[str], op: str = "_op", **sums: str | Column) -> DataFrame:
    """As ``retractable``, for update streams: a key without rows left comes once more, as ``-D``, the others as ``+I``.

    A row replaces the key's former one.
    """
    rows = F.sum(signed(F.lit(1).cast("long"), op)).alias("_rows")
    totals = [F.sum(signed(column, op)).alias(name) for name, column in sums.items()]
    summed = changes.groupBy(*keys).agg(rows, *totals)
    kind = F.when(F.col("_rows") > 0, F.lit(INSERT)).otherwise(F.lit(DELETE)).alias("_op")
    return summed.select(kind, *keys, *sums)
