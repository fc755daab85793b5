"""Bounded scans of database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, driver: str, username: str, password: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "driver": driver, "user": username, "password": password, **extra}


def partition_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Split the scan on a numeric, date or time column, one query per part."""
    if partitions < 1 or upper < lower:
        raise ValueError("need at least one partition and lower <= upper")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


# For tables that are known to be small: one query reads the table in one task.
UNSPLIT: dict[str, str] = {}


def read_table(spark: SparkSession, options: dict[str, str], split: dict[str, str], schema: str | None = None) -> DataFrame:
    """Read one table; Spark sends the needed columns and the filters to the database.

    ``split`` says how the scan is cut into tasks (``partition_options``), or that it is not (``UNSPLIT``). ``schema`` is the declared schema as DDL; columns are selected and cast to it.
    """
    df = spark.read.format("jdbc").options(**options, **split).load()
    return declared(df, schema) if schema else df


def declared(df: DataFrame, schema: str) -> DataFrame:
    """Select and cast the columns of a declared schema."""
    from pyspark.sql import types as T

    fields = T.StructType.fromDDL(schema).fields
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in fields])
