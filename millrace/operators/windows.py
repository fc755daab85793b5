"""Event-time and processing-time windows.

Each function takes a bounded table or a stream. Aggregates are built-in Spark aggregates, so Spark combines rows
before the shuffle and one busy window costs one partial row per input partition.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT_MS = {"millisecond": 1, "second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000, "week": 604_800_000}


def interval_ms(text: str) -> int:
    """Length of ``'10 minutes'``, ``'1 day'``, .. in milliseconds."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"not an interval: {text!r}")
    for number, unit in parts:
        name = unit.lower().rstrip("s")
        if name not in _UNIT_MS:
            raise ValueError(f"unknown unit in interval: {text!r}")
        total += int(number) * _UNIT_MS[name]
    return total


def day_offset(zone: str, years: tuple[int, int]) -> str:
    """``offset`` for day windows that begin at local midnight in a zone whose offset does not change in these years.

    Windows are aligned to midnight UTC; a zone that is 8 hours ahead starts its day 16 hours after that. The offset is
    looked up for each day of ``years``; where it changes, days have different lengths, and ``tumble_local_days`` is right.
    """
    first, last = years
    days = (datetime(first, 1, 1) + timedelta(days=n) for n in range((datetime(last + 1, 1, 1) - datetime(first, 1, 1)).days))
    offsets = {day.replace(tzinfo=ZoneInfo(zone)).utcoffset() for day in days}
    if len(offsets) > 1:
        raise ValueError(f"days in {zone} have different lengths: use tumble_local_days")
    return f"{int((-offsets.pop()).total_seconds()) % 86_400} seconds"


def local_time(column: str | Column, zone: str) -> Column:
    """The wall-clock time of an instant in a zone, independent of the session's zone."""
    instant = F.col(column) if isinstance(column, str) else column
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def tumble_local_days(df: DataFrame, ts: str, zone: str, aggs: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Aggregates per calendar day of a zone, whatever its offset from UTC is on that day: (local_day, keys, aggregates).

    Each instant is put into the day that the zone's clocks show, so days of 23 and 25 hours are right. On a stream use
    update or complete mode: a day that is no fixed span of event time is not closed by the watermark.
    """
    day = F.to_date(local_time(ts, zone)).alias("local_day")
    return df.groupBy(day, *keys).agg(*aggs)


def with_watermark(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Declare event time; ``delay`` is the bounded out-of-orderness. No effect on a bounded table."""
    return df.withWatermark(ts, delay) if df.isStreaming else df


def with_processing_time(df: DataFrame, name: str = "ts") -> DataFrame:
    """Add the time of processing; it is constant within one micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def _bounds(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c != "window" and c not in keys]
    return df.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *others
    )


def tumble(
    df: DataFrame, ts: str, size: str, aggs: Sequence[Column], keys: Sequence[str] = (), offset: str | None = None
) -> DataFrame:
    """Aggregate over windows ``[start, end)`` of one size that do not overlap."""
    window = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    return _bounds(df.groupBy(*keys, window.alias("window")).agg(*aggs), keys)


# How an aggregate over rows is made, and how partial ones over short windows are merged into longer windows.
_PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}

Merged = Mapping[str, tuple[str, Column | str]]


def _reduced(
    df: DataFrame, ts: str, pane: str, aggs: Merged, keys: Sequence[str], offset: str = "0 seconds"
) -> tuple[DataFrame, list[Column]]:
    """A bounded table reduced to one row per key and pane, and the aggregates that finish the work.

    The time is in ``_time``. A stream is left as it is: a pane would close before the longer windows that hold it,
    and rows that come in between would be lost to them.
    """
    unknown = {how for how, _ in aggs.values()} - _MERGE.keys()
    if unknown:
        raise ValueError(f"cannot merge {sorted(unknown)}")
    whole = [_PARTIAL[how](column).alias(name) for name, (how, column) in aggs.items()]
    if df.isStreaming:
        return df.withColumn("_time", F.col(ts)), whole
    panes = df.groupBy(*keys, F.window(ts, pane, pane, offset).alias("_pane")).agg(*whole)
    merged = [_MERGE[how](name).alias(name) for name, (how, _) in aggs.items()]
    return panes.withColumn("_time", F.window_time("_pane")), merged


def hop(
    df: DataFrame, ts: str, slide: str, size: str, aggs: Sequence[Column] | Merged, keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregate over windows of ``size`` that start every ``slide`` (the slide comes first).

    With ``aggs`` as a mapping of result names to (``sum`` | ``count`` | ``min`` | ``max``, column) and a size that is
    a multiple of the slide, the rows of a bounded table are first reduced to one per slide, and only these are copied
    into the ``size / slide`` windows that overlap. Otherwise each row is copied into its windows.
    """
    rows = df.withColumn("_time", F.col(ts))
    if isinstance(aggs, Mapping):
        if interval_ms(size) % interval_ms(slide):
            aggs = [_PARTIAL[how](column).alias(name) for name, (how, column) in aggs.items()]
        else:
            rows, aggs = _reduced(df, ts, slide, aggs, keys)
    return _bounds(rows.groupBy(*keys, F.window("_time", size, slide).alias("window")).agg(*aggs), keys)


def tumble_rows(df: DataFrame, ts: str, size: str) -> DataFrame:
    """Each row with the bounds of its window and ``window_time``, the last millisecond in it. No shuffle."""
    window = F.window(ts, size)
    return (
        df.withColumn("window", window)
        .select(
            *df.columns,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            (F.col("window.end") - F.expr("interval 1 millisecond")).alias("window_time"),
        )
    )


def cumulate(
    df: DataFrame,
    ts: str,
    step: str,
    max_size: str,
    aggs: Merged,
    keys: Sequence[str] = (),
    offset: str = "0 seconds",
) -> DataFrame:
    """Windows that all start with the period of ``max_size`` and end one ``step`` after the other.

    ``aggs`` maps a result name to (``sum`` | ``count`` | ``min`` | ``max``, column). The rows of a bounded table are
    first reduced to one per step; only these are copied into the up to ``max_size / step`` longer windows, so the
    copies do not grow with the input. A step without rows still gives a row if an earlier step of its period has one.
    """
    step_ms, max_ms = interval_ms(step), interval_ms(max_size)
    if max_ms % step_ms:
        raise ValueError("the maximum size must be a multiple of the step")
    rows, finish = _reduced(df, ts, step, aggs, keys, offset)
    # The hop of size max and slide step, cut where it crosses the end of the period. The start of the period is
    # derived by arithmetic, so that the window stays the only event-time column among the grouping keys.
    length = F.expr(f"interval {max_ms} millisecond")
    merged = (
        rows.withColumn("_period", F.window("_time", max_size, max_size, offset))
        .withColumn("_start", F.col("_period.end") - length)
        .withColumn("_window", F.window("_time", max_size, step, offset))
        .where(F.col("_window.end") <= F.col("_start") + length)
        .groupBy(*keys, "_window", "_start")
        .agg(*finish)
    )
    return merged.select(*keys, F.col("_start").alias("window_start"), F.col("_window.end").alias("window_end"), *aggs)


def tumble_by_processing_time(df: DataFrame, size: str, aggs: Sequence[Column], watermark: str | None = None) -> DataFrame:
    """Tumbling windows over the time of arrival; give ``watermark`` for append mode."""
    timed = with_processing_time(df, "_pt")
    if watermark is not None:
        timed = with_watermark(timed, "_pt", watermark)
    return tumble(timed, "_pt", size, aggs)
