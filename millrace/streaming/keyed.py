"""Keyed stateful operators on streams: running total and first-arrival join.

State lives in the state store (RocksDB), one entry per key. The rows of a key within a micro-batch are put in order
first; how many these can be is bounded by the source's rate limit (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``).
For micro-batches that are too large for that, or keys that are too hot, use ``millrace.streaming.carried``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def _rows_of(schema: T.StructType):
    return Row(*schema.names)


class _RunningTotal(StatefulProcessor):
    def __init__(self, order: str, value: str, output: T.StructType, ttl_ms: int | None):
        self.order, self.value, self.output, self.ttl_ms = order, value, output, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint", self.ttl_ms)
        self.row = _rows_of(self.output)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        total = self.total.get()[0] if self.total.exists() else None
        for row in sorted(rows, key=lambda r: r[self.order]):
            if row[self.value] is not None:
                total = (total or 0) + row[self.value]
            yield self.row(*[row[name] for name in self.output.names[:-1]], total)
        if total is not None:
            self.total.update((total,))

    def close(self) -> None:
        pass


def running_total(stream: DataFrame, key: str, order: str, value: str, name: str = "running_total") -> DataFrame:
    """Each row with the sum of its key so far; ``order`` decides inside a micro-batch, arrival across them."""
    output = T.StructType([*stream.schema.fields, T.StructField(name, T.LongType())])
    processor = _RunningTotal(order, value, output, None)
    return stream.groupBy(key).transformWithState(processor, output, "append", "None")


class _FirstArrival(StatefulProcessor):
    def __init__(self, order: str, left: T.StructType, right: T.StructType, output: T.StructType):
        self.order, self.left, self.right, self.output = order, left, right, output

    def init(self, handle: StatefulProcessorHandle) -> None:
        # which of the two is filled tells the side that came first
        self.kept = {"l": handle.getValueState("left", self.left), "r": handle.getValueState("right", self.right)}
        self.row = _rows_of(self.output)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = next((side for side, state in self.kept.items() if state.exists()), None)
        buffer = tuple(self.kept[first].get()) if first else None
        changed = False
        for row in sorted(rows, key=lambda r: r[self.order]):
            side = row["_side"]
            own = self.left if side == "l" else self.right
            payload = tuple(row[name] for name in own.names)
            first = first or side
            if side == first:
                buffer, changed = payload, True
            elif side == "l":
                yield self.row(key[0], row[self.order], *payload, *buffer)
            else:
                yield self.row(key[0], row[self.order], *buffer, *payload)
        if changed:
            self.kept[first].update(buffer)

    def close(self) -> None:
        pass


def _payload(df: DataFrame, key: str, order: str) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in (key, order)])


def first_arrival_join(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Streaming form of ``millrace.operators.running.first_arrival_join``, with the same columns."""
    left_schema, right_schema = _payload(left, key, order), _payload(right, key, order)
    if set(left_schema.names) & set(right_schema.names):
        raise ValueError("rename the columns that both sides have")
    output = T.StructType([left.schema[key], left.schema[order], *left_schema.fields, *right_schema.fields])
    tagged = (
        left.withColumn("_side", F.lit("l"))
        .unionByName(right.withColumn("_side", F.lit("r")), allowMissingColumns=True)
        .where(F.col(key).isNotNull())
    )
    processor = _FirstArrival(order, left_schema, right_schema, output)
    return tagged.groupBy(key).transformWithState(processor, output, "append", "None")
