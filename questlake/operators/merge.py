"""Joins on a key: pending rows, enrichment, upsert and update.

Rows with a NULL key never match. Left as they are they would all hash to one task, so each
join adds a second key: the row's input partition for NULL keys, 0 for others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.functions.variant import overlay

_SPREAD = "_null_spread"


def _spread_nulls(df: DataFrame, key: str) -> DataFrame:
    spread = F.when(F.col(key).isNull(), F.spark_partition_id()).otherwise(F.lit(0))
    return df.withColumn(_SPREAD, spread.cast("bigint"))


def _zero(key: str) -> Column:
    """The second key of a side without NULL keys: 0, but not as a literal, which the optimiser
    would take out of the join keys again."""
    return F.pmod(F.xxhash64(key), F.lit(1).cast("bigint")).alias(_SPREAD)


def pending_rows(source: DataFrame, stored: DataFrame, key: str, filled: str | None = None) -> DataFrame:
    """Rows of ``source`` whose key has no stored row; with ``filled``, a stored row counts
    only if that column is set. Rows with a NULL key are always pending."""
    done = stored if filled is None else stored.where(F.col(filled).isNotNull())
    done = done.where(F.col(key).isNotNull()).select(key, _zero(key))
    return _spread_nulls(source, key).join(done, [key, _SPREAD], "left_anti").drop(_SPREAD)


def enrich_merge(records: DataFrame, details: DataFrame, key: str, doc: str = "raw_data") -> DataFrame:
    """Overlay each record's document with the detail document of the same key.

    ``details`` must hold one row per key (see ``latest_by_key``). A key present in the
    detail wins even if null; records without a key or a detail stay as they are. Many
    records may share a key: AQE splits such a join partition on the record side.
    """
    right = details.where(F.col(key).isNotNull()).select(key, _zero(key), F.col(doc).alias("_detail"))
    joined = _spread_nulls(records, key).join(right, [key, _SPREAD], "left")
    merged = F.when(F.col("_detail").isNotNull(), overlay(F.col(doc), F.col("_detail"))).otherwise(F.col(doc))
    return joined.withColumn(doc, merged).select(*records.columns)


def upsert_by_key(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str],
    stamps: dict[str, Column] | None = None,
) -> DataFrame:
    """``target`` with the rows of ``source`` merged in, in the columns of ``target``.

    A row found in both takes the ``update`` columns from ``source`` and keeps the others; a
    row only in ``source`` is inserted with what ``source`` has. ``stamps`` are set on every
    row that came from ``source``. Keys must be unique on both sides.
    """
    left = _spread_nulls(target, key).withColumn("_old", F.lit(True))
    joined = left.join(incoming(_spread_nulls(source, key), [key, _SPREAD]), [key, _SPREAD], "full_outer")
    return merged_rows(joined, target.columns, source.columns, key, update, stamps)


def incoming(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The source side of an upsert's join: all but the join columns renamed, and marked ``_new``."""
    return source.select(*on, *[F.col(c).alias(f"_new_{c}") for c in source.columns if c not in on]).withColumn("_new", F.lit(True))


def merged_rows(
    joined: DataFrame, columns: Sequence[str], given: Sequence[str], key: str, update: Sequence[str], stamps: dict[str, Column] | None = None
) -> DataFrame:
    """The rows of an upsert from a full join of the target, marked ``_old``, with ``incoming`` rows
    that have the columns ``given``."""
    stamps = stamps or {}

    def merged(name: str) -> Column:
        if name == key:
            return F.col(key)
        if name in stamps:
            return F.when(F.col("_new"), stamps[name]).otherwise(F.col(name)).alias(name)
        if name not in given:
            return F.col(name)
        taken = F.col("_new") if name in update else F.col("_new") & F.col("_old").isNull()
        return F.when(taken, F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[merged(c) for c in columns])


def update_by_key(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Set the columns of ``updates`` on the rows with the same key; unknown keys have no
    effect. Keys must be unique in ``updates``."""
    changed = [c for c in updates.columns if c != key]
    right = updates.where(F.col(key).isNotNull()).select(
        key, _zero(key), *[F.col(c).alias(f"_new_{c}") for c in changed], F.lit(True).alias("_hit")
    )
    joined = _spread_nulls(target, key).join(right, [key, _SPREAD], "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in target.columns
        ]
    )
