"""Start streams with checkpoints, to files that can be read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

AVAILABLE_NOW = {"availableNow": True}


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append rows to Parquet files; the file sink makes each micro-batch visible once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def start_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write each micro-batch to a partition ``batch=<id>``, so that a repeated one replaces itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch, batch_id) if transform else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def finish(query: StreamingQuery) -> None:
    """Wait for a query over the available data and raise its error if it failed."""
    query.awaitTermination()


def read_append(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    return spark.read.schema(df.schema).parquet(path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches with their number in ``batch``."""
    return spark.read.option("basePath", path).parquet(path)
