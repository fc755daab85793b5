"""Functions with a resource that is opened once per task and closed at its end."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_with_resource(
    df: DataFrame,
    open_: Callable[[], Any],
    call: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
    close: Callable[[Any], None] | None = None,
) -> DataFrame:
    """Apply ``call(resource, batch)`` to Arrow batches; the resource is closed also when the task fails.

    For lookups in a table prefer ``operators.joins.enrich``, which stays in the JVM.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for batch in batches:
                yield call(resource, batch)
        finally:
            if close is not None:
                close(resource)

    return df.mapInPandas(run, schema)
