"""Latest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    version: Column,
    ties: Sequence[Column] = (),
) -> DataFrame:
    """One row per key: the one with the highest ``version``, NULL counting as highest.

    ``ties`` are sort columns that decide between equal versions. Spark cuts each key to one
    row per task before the shuffle (``WindowGroupLimit``), so a key with very many versions
    costs one row per task, not one task.
    """
    window = Window.partitionBy(*keys).orderBy(version.desc_nulls_first(), *ties)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
