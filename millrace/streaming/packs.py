"""Rows in packs, for state processors in Python.

Spark hands rows to a state processor, and takes them from it, value by value, which costs far more than joining them. So the
rows of a group are packed before it, whole Arrow batches at a time, and what it gives is taken apart behind it.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# a task hands its packs on after so many rows or bytes
HELD_ROWS, HELD_BYTES = 100_000, 32 << 20
# rows of a pack that a processor gives
GIVEN_ROWS = 10_000

_PACK = T.StructField("_pack", T.BinaryType())


def _values(column: pa.Array) -> list:
    """As ``to_pylist``, which makes an object of Arrow of each value first, but by whole columns for the common types."""
    kind = column.type
    if column.null_count == len(column):
        return [None] * len(column)
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return column.to_numpy(zero_copy_only=False).tolist()
    if column.null_count == 0 and (pa.types.is_integer(kind) or pa.types.is_float64(kind) or pa.types.is_boolean(kind)):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def pack(df: DataFrame, keys: Sequence[str], columns: Sequence[str | Sequence[str]], side: str) -> DataFrame:
    """``keys`` and ``_pack``: the values of ``columns`` of some rows of ``side`` with these keys; several names make a tuple."""
    schema = T.StructType([*[df.schema[k] for k in keys], _PACK])
    arrow, width = to_arrow_schema(schema), len(keys)
    groups = [[c] if isinstance(c, str) else list(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = defaultdict(list), 0, 0

        def packs() -> pa.RecordBatch:
            of_keys = [pa.array(values, field.type) for values, field in zip(zip(*held), arrow)]
            packed = [pickle.dumps((side, some)) for some in held.values()]
            return pa.RecordBatch.from_arrays([*of_keys, pa.array(packed, pa.binary())], schema=arrow)

        for batch in batches:
            values = iter([_values(column) for column in batch.columns])
            of_keys = zip(*islice(values, width))
            parts = [next(values) if isinstance(c, str) else zip(*islice(values, len(c))) for c in columns]
            for key, row in zip(of_keys, zip(*parts)):
                held[key].append(row)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= HELD_ROWS or size >= HELD_BYTES:
                yield packs()
                held, rows, size = defaultdict(list), 0, 0
        if held:
            yield packs()

    return df.select(*keys, *[name for group in groups for name in group]).mapInArrow(run, schema)


def packed_schema(*keys: T.StructField) -> T.StructType:
    return T.StructType([*keys, _PACK])


def read(rows: Iterable[Row]) -> Iterator[tuple]:
    """The rows in some packs."""
    for row in rows:
        yield from pickle.loads(row["_pack"])


def read_sides(rows: Iterable[Row], *sides: str) -> dict[str, list[tuple]]:
    """The rows of each side in some packs."""
    found: dict[str, list[tuple]] = {side: [] for side in sides}
    for row in rows:
        side, some = pickle.loads(row["_pack"])
        found[side].extend(some)
    return found


def give(rows: Iterator[tuple], **keys) -> Iterator[Row]:
    while some := list(islice(rows, GIVEN_ROWS)):
        yield Row(**keys, _pack=pickle.dumps(some))


def unpack(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that ``give`` packed."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (row for pack in batch.column(0).to_pylist() for row in pickle.loads(pack))
            while some := list(islice(rows, GIVEN_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*some), arrow)], schema=arrow)

    return df.select("_pack").mapInArrow(run, schema)
