"""Projection, filter, computed columns and plan text. Everything is a built-in expression inside one codegen stage."""

from __future__ import annotations

import contextlib
import io
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns)


def keep(df: DataFrame, *conditions: str | Column) -> DataFrame:
    """Rows for which every condition is true; NULL counts as not true."""
    for condition in conditions:
        df = df.where(condition)
    return df


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan that ``explain`` prints, as a string."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def insert_columns(df: DataFrame, sink_schema: Mapping[str, str], columns: Sequence[str] | None = None) -> DataFrame:
    """Shape a select's output for a sink.

    The output columns are matched by position with ``columns`` (all sink columns if not given), cast to the sink's
    types, and sink columns that are not listed become NULL.
    """
    names = list(columns if columns is not None else sink_schema)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} values for {len(names)} columns")
    unknown = [name for name in names if name not in sink_schema]
    if unknown:
        raise ValueError(f"the sink has no column {unknown}")
    given = df.toDF(*names)
    return given.select(
        *[
            (F.col(name) if name in names else F.lit(None)).cast(kind).alias(name)
            for name, kind in sink_schema.items()
        ]
    )
