"""Order-dependent operators on bounded tables: running total and first-arrival join.

A window over one key runs in one task, and one key may hold a large part of all rows. Therefore the order column is
cut into blocks with about the same number of rows, and a window covers one key within one block. What a block needs
to know about the earlier ones is a small summary per key and block, made by an aggregate that is combined before the
shuffle. So no task gets more than about one block, whatever the keys look like, and the result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import fair_partitions


# number of the block that stands for everything before the given rows
BEFORE_ALL = -1


def _as_number(df: DataFrame, order: str) -> Column:
    """The order column as a number that grows with it, whatever the session's time zone is."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(order).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        since = f"(`{order}` - TIMESTAMP_NTZ'1970-01-01 00:00:00')"
        units = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}
        return F.expr(" + ".join(f"CAST(extract({u} FROM {since}) AS DOUBLE) * {n}" for u, n in units.items()))
    return F.col(order).cast("double")


def with_block(df: DataFrame, order: str, blocks: int | None = None, name: str = "_block") -> DataFrame:
    """Number the blocks of equal row count along a numeric or time column.

    The cut points come from Spark's approximate quantiles (one pass over one column). They only decide where the
    work is divided; every row falls into exactly one block and blocks follow the order of the column.
    """
    n = blocks if blocks is not None else fair_partitions(df.sparkSession)
    position = _as_number(df, order)
    if n <= 1:
        return df.withColumn(name, F.lit(0))
    shares = [i / n for i in range(1, n)]
    cuts = df.select(position.alias("_position")).approxQuantile("_position", shares, 1 / (4 * n))
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        return df.withColumn(name, F.lit(0))
    placed = df.withColumn("_position", position)
    numbered = Bucketizer(splits=splits, inputCol="_position", outputCol="_number").transform(placed)
    return numbered.withColumn(name, F.col("_number").cast("int")).drop("_position", "_number")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str | Column,
    name: str = "running_total",
    blocks: int | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Sum of the values of a key up to and including each row; ``order`` must be unique within a key.

    ``before`` gives totals to start from, with the keys and a column ``_sum`` (see ``totals``).
    """
    column = F.col(value) if isinstance(value, str) else value
    rows = with_block(df.withColumn("_value", column), order, blocks)
    sums = rows.groupBy(*keys, "_block").agg(F.sum("_value").alias("_sum"))
    if before is not None:
        sums = sums.unionByName(before.withColumn("_block", F.lit(BEFORE_ALL)))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    brought = sums.select(*keys, "_block", F.sum("_sum").over(earlier).alias("_value"))
    return (
        _open_blocks(rows, brought)
        .withColumn(name, F.sum("_value").over(_inside([*keys, "_block"], order)))
        .where("_is_row")
        .select(*df.columns, name)
    )


def totals(df: DataFrame, keys: Sequence[str], value: str | Column, before: DataFrame | None = None) -> DataFrame:
    """The total per key after these rows, to start the next ones from."""
    column = F.col(value) if isinstance(value, str) else value
    sums = df.groupBy(*keys).agg(F.sum(column).alias("_sum"))
    return sums if before is None else sums.unionByName(before).groupBy(*keys).agg(F.sum("_sum").alias("_sum"))


def first_arrival_join(left: DataFrame, right: DataFrame, key: str, order: str, blocks: int | None = None) -> DataFrame:
    """Join two row sequences by who came first.

    For each key the side of its very first row is buffered for good: a new row of that side replaces the buffer, and
    each row of the other side comes out joined with the buffer of that moment. ``order`` is a column of both inputs
    that is unique within a key. The result has the key, the order of the emitting row and the other columns of both.
    """
    return join_tagged(tag_sides(left, right, key, order), key, order, blocks)


def tag_sides(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of both sides with ``_side`` and their other columns in ``_l`` or ``_r``; a NULL key never meets a partner."""
    left_columns = [c for c in left.columns if c not in (key, order)]
    right_columns = [c for c in right.columns if c not in (key, order)]
    if set(left_columns) & set(right_columns):
        raise ValueError("rename the columns that both sides have")
    lefts = left.select(key, order, F.lit("l").alias("_side"), F.struct(*left_columns).alias("_l"))
    rights = right.select(key, order, F.lit("r").alias("_side"), F.struct(*right_columns).alias("_r"))
    return lefts.unionByName(rights, allowMissingColumns=True).where(F.col(key).isNotNull())


def _of_side(column: str, side: str) -> Column:
    return F.when(F.col("_side") == side, F.col(column))


def join_tagged(
    tagged: DataFrame, key: str, order: str, blocks: int | None = None, before: DataFrame | None = None
) -> DataFrame:
    """First-arrival join of tagged rows; ``before`` is what earlier rows left behind (see ``arrivals``)."""
    rows = with_block(tagged, order, blocks)
    blocks_seen = rows.groupBy(key, "_block").agg(
        F.min_by("_side", order).alias("_first"),
        F.max_by("_l", _of_side(order, "l")).alias("_l"),
        F.max_by("_r", _of_side(order, "r")).alias("_r"),
    )
    if before is not None:
        blocks_seen = blocks_seen.unionByName(before.withColumn("_block", F.lit(BEFORE_ALL)))
    by_key = Window.partitionBy(key).orderBy("_block")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    brought = blocks_seen.select(
        key,
        "_block",
        F.first("_first").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"),
        F.last("_l", ignorenulls=True).over(earlier).alias("_l"),
        F.last("_r", ignorenulls=True).over(earlier).alias("_r"),
    )
    inside = _inside([key, "_block"], order)
    emitted = (
        _open_blocks(rows, brought)
        .withColumn("_first", F.first("_first").over(inside))
        .withColumn("_l", F.last("_l", ignorenulls=True).over(inside))
        .withColumn("_r", F.last("_r", ignorenulls=True).over(inside))
        .where(F.col("_is_row") & (F.col("_side") != F.col("_first")))
    )
    return emitted.select(key, order, "_l.*", "_r.*")


def arrivals(tagged: DataFrame, key: str, order: str, before: DataFrame | None = None) -> DataFrame:
    """Per key the side that came first and its newest row, for the rows that come next."""
    seen = tagged.groupBy(key).agg(
        F.min_by("_side", order).alias("_first"),
        F.max_by("_l", _of_side(order, "l")).alias("_l"),
        F.max_by("_r", _of_side(order, "r")).alias("_r"),
    )
    if before is not None:
        both = seen.withColumn("_age", F.lit(1)).unionByName(before.withColumn("_age", F.lit(0)))
        seen = both.groupBy(key).agg(
            F.min_by("_first", "_age").alias("_first"),
            F.max_by("_l", F.when(F.col("_l").isNotNull(), F.col("_age"))).alias("_l"),
            F.max_by("_r", F.when(F.col("_r").isNotNull(), F.col("_age"))).alias("_r"),
        )
    return seen.select(
        key, "_first", F.when(F.col("_first") == "l", F.col("_l")).alias("_l"), F.when(F.col("_first") == "r", F.col("_r")).alias("_r")
    )


def _open_blocks(rows: DataFrame, brought: DataFrame) -> DataFrame:
    """Put the row with what the earlier blocks brought in front of the rows of each key and block."""
    return rows.withColumn("_is_row", F.lit(True)).unionByName(
        brought.withColumn("_is_row", F.lit(False)), allowMissingColumns=True
    )


def _inside(keys: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*keys).orderBy("_is_row", order).rowsBetween(Window.unboundedPreceding, 0)
