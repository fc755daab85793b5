"""Lateral left join with a table function."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lateral_left_join(df: DataFrame, function: str, arguments: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each row with every row that the registered table function gives for it, or with NULLs if it gives none.

    A SQL table function is inlined by the optimizer into a plain join; a Python one runs in Arrow batches.
    """
    spark = df.sparkSession
    view = f"_lateral_{id(df)}"
    df.createOrReplaceTempView(view)
    try:
        call = f"{function}({', '.join('s.' + a for a in arguments)}) AS t({', '.join(columns)})"
        made = ", ".join(f"t.{c}" for c in columns)
        return spark.sql(f"SELECT s.*, {made} FROM {view} s LEFT JOIN LATERAL {call} ON true")
    finally:
        spark.catalog.dropTempView(view)
