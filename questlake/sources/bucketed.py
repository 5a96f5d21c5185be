"""Stored tables in buckets of a key, so that joins on it leave the stored rows where they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlake.operators.merge import incoming, merged_rows


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, aligned: bool = False) -> DataFrame:
    """Store ``df`` in the new folder ``path`` as the table ``name``, in ``buckets`` buckets of ``key``.

    One shuffle puts each bucket into one file. Rows with a NULL key are not shuffled: each task
    writes its own to the bucket that they share, so many of them are no hot spot. ``aligned`` rows,
    such as those of ``upsert_in_buckets``, are in tasks of one bucket each and are not shuffled at all.
    """
    keyed = df.where(F.col(key).isNotNull()).repartition(buckets, key)
    whole = df if aligned else keyed.union(df.where(F.col(key).isNull()))
    whole.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Name a folder that ``write_bucketed`` wrote, in a session whose catalog does not know it."""
    quoted = {n: "`" + n.replace("`", "``") + "`" for n in (name, key)}
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {quoted[name]} ({columns}) USING parquet CLUSTERED BY ({quoted[key]}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)


def pending_in_buckets(source: DataFrame, stored: DataFrame, key: str, buckets: int, filled: str | None = None) -> DataFrame:
    """Rows of ``source`` whose key has no row in the bucketed table ``stored``; with ``filled``, a
    stored row counts only if that column is set. Rows with a NULL key are always pending.

    Only ``source`` is shuffled, to the buckets of the table; ``buckets`` must be the table's number
    and the key of one type on both sides, or the table is shuffled too. A key that repeats in
    ``source`` stays in one task: cut it to one row first (see ``latest_by_key``) if it is hot.
    """
    done = stored if filled is None else stored.where(F.col(filled).isNotNull())
    done = done.where(F.col(key).isNotNull()).select(key).hint("merge")
    keyed = source.where(F.col(key).isNotNull()).repartition(buckets, key)
    return keyed.join(done, key, "left_anti").union(source.where(F.col(key).isNull()))


def upsert_in_buckets(
    stored: DataFrame, source: DataFrame, key: str, buckets: int, update: Sequence[str], stamps: dict[str, Column] | None = None
) -> DataFrame:
    """As ``upsert_by_key``, into the bucketed table ``stored``: only ``source`` is shuffled.

    A row with a NULL key matches none: stored ones stay, those of ``source`` are inserted. Write
    the result with ``write_bucketed(..., aligned=True)`` to a new folder; the rows are then stored
    where they were joined, and readers of the old table are not disturbed.
    """
    has_key = F.col(key).isNotNull()
    old = stored.where(has_key).withColumn("_old", F.lit(True)).hint("merge")
    joined = old.join(incoming(source.where(has_key).repartition(buckets, key), [key]), key, "full_outer")
    merged = merged_rows(joined, stored.columns, source.columns, key, update, stamps)
    inserted = incoming(source.where(~has_key), [key])
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema if f.name != key]
    inserted = inserted.select("*", *missing, F.lit(None).cast("boolean").alias("_old"))
    inserted = merged_rows(inserted, stored.columns, source.columns, key, update, stamps)
    return merged.union(stored.where(~has_key)).union(inserted)
