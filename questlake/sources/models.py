"""Named models: views that are evaluated when read, and tables that are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` under ``name``; every read evaluates it again."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` as the table ``name``, replacing its content."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
