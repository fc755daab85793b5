"""Delimited logs decoded by declared type, as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _decode(text: Column, kind: T.DataType) -> Column:
    """One field; empty text is NULL and bad text fails the query."""
    value = F.when(text != "", text)
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.IntegerType, T.ShortType, T.LongType)):
        return value.cast(kind)
    if isinstance(kind, T.DecimalType):
        # rounded half up to the scale; NULL if it then has too many digits
        wrong = value.isNotNull() & value.try_cast("double").isNull()
        error = F.raise_error(F.concat(F.lit("not a number: "), value)).cast(kind)
        return F.when(wrong, error).otherwise(value.try_cast(kind))
    if isinstance(kind, T.DateType):
        # the text is a number of days since 1970-01-01
        return F.date_from_unix_date(value.cast("int"))
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return value.cast(kind)
    raise ValueError(f"unsupported data type: {kind.simpleString()}")


def deserialize_columns(
    lines: DataFrame,
    schema: str | T.StructType,
    separator: str = ",",
    column: str = "value",
    on_malformed: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Typed columns from lines of delimited text.

    The separator is taken literally. A line with another number of fields than the schema is dropped, or fails the
    query with ``on_malformed='fail'``. ``observation`` receives the metrics ``lines`` and ``malformed``.
    """
    if on_malformed not in ("drop", "fail"):
        raise ValueError("on_malformed must be drop or fail")
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    quoted = "\\Q" + separator + "\\E"
    parts = lines.select(F.split(F.col(column), quoted, -1).alias("_f"), F.col(column).alias("_line"))
    good = F.size("_f") == len(struct.fields)
    if observation is not None:
        parts = parts.observe(observation, F.count(F.lit(1)).alias("lines"), F.count_if(~good).alias("malformed"))
    if on_malformed == "fail":
        error = F.raise_error(F.concat(F.lit("wrong number of fields: "), F.col("_line"))).cast("array<string>")
        parts = parts.select(F.when(good, F.col("_f")).otherwise(error).alias("_f"))
    else:
        parts = parts.where(good)
    return parts.select(*[_decode(F.col("_f")[i], f.dataType).alias(f.name) for i, f in enumerate(struct.fields)])


def scan_log(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    separator: str = ",",
    parallelism: int | None = None,
    on_malformed: str = "drop",
    observation: Observation | None = None,
) -> DataFrame:
    """Bounded scan of delimited files; Spark splits big files by bytes, ``parallelism`` sets another number of parts."""
    lines = spark.read.text(path)
    if parallelism is not None:
        lines = lines.repartition(parallelism)
    return deserialize_columns(lines, schema, separator, on_malformed=on_malformed, observation=observation)


def tail_folder(spark: SparkSession, path: str, schema: str | T.StructType, separator: str = ",", on_malformed: str = "drop") -> DataFrame:
    """Stream over a folder of rolling logs: each file is complete when it appears."""
    return deserialize_columns(spark.readStream.text(path), schema, separator, on_malformed=on_malformed)
