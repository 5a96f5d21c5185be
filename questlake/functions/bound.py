"""Computing a value once per row, and names for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    Spark writes a computed column's expression out wherever it is used: at each use in a
    filter pushed below the projection, and for each element inside a lambda. The argument
    of a lambda is not written out.
    """
    return F.transform(F.array(value), use)[0]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that begins no column's name of ``df``."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name
