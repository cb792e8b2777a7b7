"""Helpers for column expressions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    A column of an earlier projection may be put back into a later expression, and would
    then be computed for every element that a lambda looks at.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
