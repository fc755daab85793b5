"""Cutting a table into parts of neighbouring sort keys, with cut points that the caller knows."""

from __future__ import annotations

import bisect
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows looked at per cut point, on average, and characters of a sampled key that are kept.
SAMPLED, KEY_CHARS = 40, 200


def cut_points(keys: DataFrame, parts: int) -> list[tuple]:
    """At most ``parts - 1`` increasing tuples that cut ``keys`` (text, text, number) into parts of about equal size.

    They come from a sample of about ``parts * SAMPLED`` rows; only the evenness of the parts depends on it, never a
    result. Long texts are shortened, which still gives valid cut points.
    """
    rows = keys.count()
    if rows == 0 or parts < 2:
        return []
    first, second, third = keys.columns
    sample = (
        keys.sample(min(1.0, parts * SAMPLED / rows), seed=42)
        .select(F.substring(first, 1, KEY_CHARS), F.substring(second, 1, KEY_CHARS), F.coalesce(third, F.lit(0)))
        .collect()
    )
    found = sorted(tuple(r) for r in sample)
    return sorted({found[i * len(found) // parts] for i in range(1, parts)}) if found else []


def part_of(points: Sequence[tuple], first: Column, second: Column, third: Column) -> Column:
    """Number of the part that a key falls into."""
    points = list(points)

    @F.pandas_udf("int")
    def part(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(points, key) for key in zip(a, b, c)], dtype="int32")

    return part(first, second, F.coalesce(third, F.lit(0)).cast("long"))
