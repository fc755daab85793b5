"""Sorting a bounded table; for a stream see ``millrace.streaming.ordering``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_time(df: DataFrame, ts: str, *ties: str) -> DataFrame:
    """Ascending by time. Spark samples the columns and sorts ranges in parallel; ``ties`` split a crowded moment."""
    return df.orderBy(F.col(ts).asc(), *ties)
