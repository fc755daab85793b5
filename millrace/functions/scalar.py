"""Scalar functions as column expressions; the SQL names are in ``registry``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def calc_bal(income: Column | str, expense: Column | str) -> Column:
    """Income minus expense, a missing one counted as 0; never NULL."""
    return F.coalesce(_column(income), F.lit(0)) - F.coalesce(_column(expense), F.lit(0))


def quotient(number: Column | str, dividend: int = 10) -> Column:
    """``dividend`` divided by the number, cut to an integer; a zero fails the query."""
    value = _column(number)
    zero = F.raise_error(F.lit("division by zero")).cast("long")
    return F.when(value == 0, zero).otherwise(F.call_function("div", F.lit(dividend).cast("long"), value.cast("long")))


def distance_quotient(text: Column | str) -> Column:
    """``abs(10 div (10 - v))`` for a number given as text; bad text and the number 10 fail the query."""
    return F.abs(quotient(F.lit(10).cast("long") - _column(text).cast("int")))
