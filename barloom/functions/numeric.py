"""Column expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0 (plain division raises under ANSI mode)."""
    return F.try_divide(a, b)


def finite(c: Column) -> Column:
    """NULL for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def count_where(condition: Column) -> Column:
    """Number of rows where the condition holds; NULL counts as not holding."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")
