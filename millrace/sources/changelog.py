"""Change-data envelopes and changelogs.

A changelog is a table with a column ``_op``: ``+I`` adds a row and ``-D`` removes one. An update is a removal of the
old row followed by an insertion of the new one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.messages import message_stream

# Row kinds of a changelog and operation codes of the envelope.
INSERT, DELETE = "+I", "-D"
CREATE_CODE, SNAPSHOT_CODE, UPDATE_CODE, DELETE_CODE = "c", "r", "u", "d"


def decode_changes(df: DataFrame, schema: str | T.StructType, column: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """Rows of a changelog from JSON envelopes ``{"before": .., "after": .., "op": ..}``.

    ``c`` and ``r`` insert ``after``, ``d`` removes ``before`` and ``u`` does both. ``carry`` names columns of the
    input to keep. The column ``_part`` is 0 for a removal and 1 for an insertion, so that an ordering of the messages
    extends to the rows. An envelope without the image it needs fails the query; a NULL message is skipped.
    """
    row = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    envelope = T.StructType(
        [T.StructField("before", row), T.StructField("after", row), T.StructField("op", T.StringType())]
    )
    message = F.from_json(column, envelope, {"mode": "FAILFAST"}).alias("_m")

    def image(name: str) -> Column:
        broken = F.concat(F.lit(f"no {name} image in "), F.to_json("_m"))
        return F.when(F.col(f"_m.{name}").isNull(), F.raise_error(broken).cast(row)).otherwise(F.col(f"_m.{name}"))

    def entry(op: str, part: int, name: str) -> Column:
        return F.struct(F.lit(op).alias("_op"), F.lit(part).alias("_part"), image(name).alias("_row"))

    op = F.col("_m.op")
    unknown = F.raise_error(F.concat(F.lit("unknown operation in "), F.to_json("_m")))
    entries = (
        F.when(op.isin(CREATE_CODE, SNAPSHOT_CODE), F.array(entry(INSERT, 1, "after")))
        .when(op == UPDATE_CODE, F.array(entry(DELETE, 0, "before"), entry(INSERT, 1, "after")))
        .when(op == DELETE_CODE, F.array(entry(DELETE, 0, "before")))
        .otherwise(F.array(F.struct(F.lit(INSERT).alias("_op"), F.lit(1).alias("_part"), unknown.cast(row).alias("_row"))))
    )
    return (
        df.where(F.col(column).isNotNull())
        .select(*carry, message)
        .select(*carry, F.explode(entries).alias("_e"))
        .select(*carry, "_e._op", "_e._part", "_e._row.*")
    )


def change_stream(
    spark: SparkSession,
    options: dict[str, str],
    columns: Mapping[str, str] | str,
    format: str = "kafka",
    path: str | None = None,
) -> DataFrame:
    """A changelog from a stream of envelopes; ``columns`` is DDL or maps names to types, decided at run time."""
    schema = columns if isinstance(columns, str) else ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    return decode_changes(message_stream(spark, options, format, path), schema).drop("_part")


def encode_change(op: Column, before: Column | None, after: Column | None) -> Column:
    """An envelope as JSON text."""
    fields = [op.alias("op")]
    if before is not None:
        fields.append(before.alias("before"))
    if after is not None:
        fields.append(after.alias("after"))
    return F.to_json(F.struct(*fields))


def materialize(changes: DataFrame, op: str = "_op", ignore: Sequence[str] = ()) -> DataFrame:
    """The rows that a changelog leaves, each as often as it is left.

    Counting is combined before the shuffle. Copies are made in two steps, so that a row with very many copies does
    not need one huge array.
    """
    columns = [c for c in changes.columns if c != op and c not in ignore]
    sign = F.when(F.col(op) == INSERT, F.lit(1)).otherwise(F.lit(-1)).cast("long")
    net = changes.groupBy(*columns).agg(F.sum(sign).alias("_n")).where("_n > 0")
    chunk = F.lit(1 << 12).cast("long")
    starts = net.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, chunk)))
    copies = F.sequence(F.lit(1).cast("long"), F.least(chunk, F.col("_n") - F.col("_from")))
    return starts.withColumn("_copy", F.explode(copies)).select(*columns)


def latest_by_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "_op") -> DataFrame:
    """The current row per key of a changelog over a keyed table: the last change by ``order``, unless it removes."""
    columns = [c for c in changes.columns if c not in keys and c not in order]
    last = F.max_by(F.struct(*columns), F.struct(*order)).alias("_last")
    kept = [c for c in columns if c != op]
    return (
        changes.groupBy(*keys).agg(last).where(F.col(f"_last.{op}") == INSERT).select(*keys, *[f"_last.{c}" for c in kept])
    )
