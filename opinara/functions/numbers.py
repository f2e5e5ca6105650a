"""Number helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int) -> Column:
    """Round half to even on the binary value, the rule Python's ``round`` follows."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def one_of(*cases: tuple[Column, object], default: object = None) -> Column:
    """First matching case, read top to bottom."""
    result = None
    for condition, value in cases:
        result = F.when(condition, value) if result is None else result.when(condition, value)
    return result.otherwise(default)
