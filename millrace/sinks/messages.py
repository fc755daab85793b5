"""JSON messages to Kafka or files, and the console."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def to_json_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON object per row in ``value``, with an optional message key."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def kafka_sink_options(topic: str, servers: str, **extra: str) -> dict[str, str]:
    return {"topic": topic, "kafka.bootstrap.servers": servers, **extra}


def write_messages(
    df: DataFrame, options: dict[str, str], checkpoint: str | None = None, format: str = "kafka", path: str | None = None, trigger: dict | None = None
) -> StreamingQuery | None:
    """Write the column ``value``; a stream is started, a bounded table is written at once. ``text`` writes files."""
    if df.isStreaming:
        writer = df.writeStream.format(format).options(**options).outputMode("append").option("checkpointLocation", checkpoint)
        writer = writer.trigger(**trigger) if trigger else writer
        return writer.start(path) if path else writer.start()
    writer = df.write.format(format).options(**options)
    writer.mode("append").save(path) if path else writer.save()
    return None


def print_rows(
    df: DataFrame, checkpoint: str | None = None, mode: str = "append", trigger: dict | None = None,
    write: Callable[[str], None] = print,
) -> StreamingQuery | None:
    """Print every row, one line each; for a stream those of each micro-batch.

    The rows come to the driver one partition after the other, so it holds one partition at a time.
    """

    def lines(rows: DataFrame, batch_id: int | None = None) -> None:
        for row in rows.toLocalIterator():
            write(", ".join(f"{name}={value}" for name, value in row.asDict().items()))

    if not df.isStreaming:
        lines(df)
        return None
    writer = df.writeStream.outputMode(mode).foreachBatch(lines)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def preview_rows(df: DataFrame, rows: int) -> None:
    """Show the first rows of a bounded table as a table."""
    df.show(rows, truncate=False)
