"""Retention of date-partitioned folders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlake.sources import hdfs

# Fixed value: days that bronze is kept.
RETENTION_DAYS = 30


def is_expired(day: Column, as_of: dt.date, days: int = RETENTION_DAYS) -> Column:
    """True for dates more than ``days`` before ``as_of``; on a partition column it prunes."""
    return day < F.date_sub(F.lit(as_of), days)


def expired_dates(df: DataFrame, day: str, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """The expired dates with their row counts."""
    return df.where(is_expired(F.col(day), as_of, days)).groupBy(day).agg(F.count("*").alias("n"))


def drop_expired(
    spark: SparkSession, path: str, as_of: dt.date, days: int = RETENTION_DAYS, column: str = "ingest_date"
) -> list[str]:
    """Delete the expired date folders of ``path``, named ``column=2026-06-13`` or ``2026-06-13``;
    returns their names. Works on folder names and reads no data."""
    oldest, gone = as_of - dt.timedelta(days=days), []
    for folder in hdfs.child_folders(spark, path):
        name, named, value = folder.partition("=")
        try:
            expired = (name == column or not named) and dt.date.fromisoformat(value if named else name) < oldest
        except ValueError:
            continue
        if expired:
            hdfs.delete_folder(spark, f"{path}/{folder}")
            gone.append(folder)
    return gone
