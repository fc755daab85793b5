"""Message streams: Kafka options, plain strings and JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_source_options(topic: str, servers: str, group_id: str | None = None, starting: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a Kafka source that starts at the latest offset unless told otherwise."""
    options = {"subscribe": topic, "kafka.bootstrap.servers": servers, "startingOffsets": starting}
    if group_id:
        options["kafka.group.id"] = group_id
    return {**options, **extra}


def message_stream(spark: SparkSession, options: dict[str, str], format: str = "kafka", path: str | None = None) -> DataFrame:
    """A stream with one column ``value`` that holds the message text; ``format='text'`` reads files instead."""
    reader = spark.readStream.format(format).options(**options)
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


def decode_json(df: DataFrame, schema: str | T.StructType, column: str = "value", strict: bool = False) -> DataFrame:
    """Turn JSON text into typed columns; a missing field is NULL and malformed JSON fails the query.

    ``strict`` also refuses field names that the schema does not have.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = F.col(column)
    if strict:
        known = F.array(*[F.lit(name) for name in struct.names])
        unknown = F.array_except(F.json_object_keys(text), known)
        text = F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown field in "), text)).cast("string")).otherwise(text)
    record = F.from_json(text, struct, {"mode": "FAILFAST"})
    return df.where(F.col(column).isNotNull()).select(record.alias("_record")).select("_record.*")


def json_stream(
    spark: SparkSession, options: dict[str, str], schema: str | T.StructType, format: str = "kafka", path: str | None = None
) -> DataFrame:
    """A stream of JSON messages as typed columns."""
    return decode_json(message_stream(spark, options, format, path), schema)
