"""Sorting a stream by event time.

Rows wait in Spark's state store, as the lists of a windowed aggregate: by time bucket, a salt and the micro-batch that
brought them. Spark gives the lists of a bucket when its watermark has reached the end. What a micro-batch gives is sorted
by a parallel range sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.ordering import order_by_time
from millrace.streaming.runner import AVAILABLE_NOW

SALTS = 32  # lists of one bucket and micro-batch


def start_ordered(
    df: DataFrame,
    ts: str,
    path: str,
    checkpoint: str,
    delay: str = "10 seconds",
    bucket: str = "1 minute",
    ties: Sequence[str] = (),
    trigger: dict | None = None,
    salts: int = SALTS,
) -> StreamingQuery:
    """Write the stream in ascending event time: micro-batch after micro-batch, each sorted by a parallel range sort.

    A bucket is complete when the watermark, the latest time less ``delay``, has reached its end; Spark moves the watermark
    between micro-batches. Rows of complete buckets that come still later are dropped, and so are rows without a time.
    Within a micro-batch the files follow each other by name. ``ties`` order rows of the same time.

    The rows of a bucket lie in ``salts`` lists, by a hash of their columns. The time of the micro-batch (which Spark keeps
    with its offsets) is a key too, so no list is read or written again while it waits. A repeated micro-batch writes over
    what its first run wrote.
    """
    complete = f"{checkpoint}-complete"
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    timed = df.where(F.col(ts).isNotNull()).select(F.struct(*df.columns).alias("_row"), F.col(ts).cast("timestamp").alias("_at"))
    salt = F.pmod(F.xxhash64(*[F.col("_row").getField(name) for name in hashed]), F.lit(salts))
    waiting = (
        timed.withWatermark("_at", delay)
        .groupBy(F.window("_at", bucket), salt.alias("_salt"), F.current_timestamp().alias("_came"))
        .agg(F.collect_list("_row").alias("_rows"))
    )
    given = waiting.select(F.inline("_rows"))

    def save(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        # a range sort reads its input twice, and the state is to be asked once
        rows.write.mode("overwrite").parquet(complete)
        written = spark.read.schema(df.schema).parquet(complete)
        order_by_time(written, ts, *ties).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = given.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(save)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def with_position(rows: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of ``start_ordered`` as they were written: micro-batch, file in the order of names, row in the file.

    Files are counted first, so that each row only needs the rows before its own file.
    """
    file = F.col("_metadata.file_name")
    placed = rows.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("batch", "_file").agg(F.count(F.lit(1)).alias("_size"))
    # one row per file
    before = F.sum("_size").over(Window.orderBy("batch", "_file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("batch", "_file", F.coalesce(before, F.lit(0)).alias("_start"))
    return placed.join(starts, ["batch", "_file"]).select(
        *rows.columns, (F.col("_start") + F.col("_row") + 1).alias(name)
    )
