"""Order-dependent operators on streams in large micro-batches.

``millrace.streaming.keyed`` keeps one state entry per key and handles the rows of a key one after the other, which
suits small, frequent micro-batches. Here a micro-batch is handled like a bounded table: the rows of a hot key are
split into blocks, everything stays in the JVM, and what the next micro-batch needs (one row per key) is kept in files
(``millrace.streaming.kept``). A micro-batch reads and writes what is kept of its own keys only.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import running
from millrace.streaming.kept import KeptRows
from millrace.streaming.runner import AVAILABLE_NOW

Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


def start_carried(
    stream: DataFrame,
    keys: Sequence[str],
    step: Step,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    buckets: int = 64,
    ttl_seconds: float | None = None,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Run ``step(rows, kept)``, which gives the output and what to keep, for each micro-batch.

    ``kept`` has one row per key of the micro-batch that was kept before; the micro-batch is read once. With
    ``ttl_seconds`` a key that had no rows for that long starts anew. ``buckets`` belongs to the checkpoint.
    """
    keys = list(keys)

    def save(rows: DataFrame, batch_id: int) -> None:
        rows.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        now = int(clock() * 1000)
        rows = rows.persist()
        schema = step(rows, None)[1].schema
        others = [c for c in schema.names if c not in keys]

        def latest(changes: DataFrame) -> DataFrame:
            kept = changes if ttl_seconds is None else changes.where(F.col("_at") >= now - int(ttl_seconds * 1000))
            newest = F.max_by(F.struct(*others, "_at", "_batch"), "_batch").alias("_newest")
            return kept.groupBy(*keys).agg(newest).select(*keys, "_newest.*")

        numbers = [T.StructField("_at", T.LongType()), T.StructField("_batch", T.LongType())]
        store = KeptRows(f"{checkpoint}-kept", keys, T.StructType([*schema.fields, *numbers]), latest, buckets)
        touched = rows.select(*keys).distinct()
        before = latest(store.before(touched, batch_id)).select(*schema.names).persist() if batch_id else None
        output, after = step(rows, before)
        store.write(after.withColumns({"_at": F.lit(now).cast("long"), "_batch": F.lit(batch_id).cast("long")}), batch_id)
        output.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        for df in (rows, before):
            if df is not None:
                df.unpersist()

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def start_running_total(
    stream: DataFrame, key: str, order: str, value: str, path: str, checkpoint: str,
    name: str = "running_total", blocks: int | None = None, trigger: dict | None = None, **options,
) -> StreamingQuery:
    """Each row with the sum of its key so far; ``options`` as in ``start_carried``."""

    def step(rows: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        return running.running_total(rows, [key], order, value, name, blocks, before), running.totals(rows, [key], value, before)

    return start_carried(stream, [key], step, path, checkpoint, trigger, **options)


def start_first_arrival_join(
    left: DataFrame, right: DataFrame, key: str, order: str, path: str, checkpoint: str,
    blocks: int | None = None, trigger: dict | None = None, **options,
) -> StreamingQuery:
    """First-arrival join; ``order`` decides inside a micro-batch, arrival across them."""

    def step(rows: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        return running.join_tagged(rows, key, order, blocks, before), running.arrivals(rows, key, order, before)

    return start_carried(running.tag_sides(left, right, key, order), [key], step, path, checkpoint, trigger, **options)
