"""SQL names of the functions.

SQL-bodied functions are inlined by the optimizer, so a query that calls them stays in the JVM. Names given with
``functions`` are registered from Python instead.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.functions.table import DETAIL_ROWS, GetDetail


def _detail_values() -> str:
    def cell(value: int | None) -> str:
        return "CAST(NULL AS INT)" if value is None else str(value)

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in DETAIL_ROWS)


def sql_functions() -> dict[str, str]:
    """Signature and body of each SQL function."""
    return {
        "calc_bal": "(a INT, b INT) RETURNS INT RETURN coalesce(a, 0) - coalesce(b, 0)",
        "func1": "(num INT) RETURNS BIGINT RETURN 10 DIV num",
        "get_detail": "(uid INT) RETURNS TABLE(income INT, expense INT) "
        "RETURN SELECT d.income, d.expense "
        f"FROM VALUES {_detail_values()} AS d(record_uid, income, expense) WHERE d.record_uid = get_detail.uid",
    }


def register_function(spark: SparkSession, name: str, function) -> None:
    """Register a scalar or grouped Python function (``udf``/``pandas_udf``) or a table function (``udtf``)."""
    if hasattr(function, "func") and hasattr(function, "returnType") and isinstance(getattr(function, "func"), type):
        spark.udtf.register(name, function)
    else:
        spark.udf.register(name, function)


def register_all(spark: SparkSession) -> None:
    """Temporary functions of this session: calc_bal, func1, get_detail and get_detail_py."""
    for name, rest in sql_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{rest}")
    register_function(spark, "get_detail_py", GetDetail)
