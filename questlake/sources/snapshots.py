"""Published tables: full-refresh snapshots, and a keyed table kept in hash buckets."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from questlake.operators.merge import upsert_by_key
from questlake.session import materialise, shredded_variants
from questlake.sources import hdfs

_POINTER = "_CURRENT"


def publish(df: DataFrame, base: str, name: str, columns: Sequence[str], keep: int = 2) -> int:
    """Replace the published table ``name`` with ``columns`` of ``df``; returns the row count.

    The rows go to a new version folder, then a pointer file is switched to it: readers see
    the old table or the new one. The last ``keep`` versions stay for readers still on them.
    """
    spark, counted = df.sparkSession, Observation()
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    version = f"v-{stamp}-{uuid.uuid4().hex[:8]}"
    with shredded_variants(spark):
        df.select(*columns).observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(f"{base}/{name}/{version}")
    hdfs.replace_small(spark, f"{base}/{name}/{_POINTER}", version)
    versions = [v for v in hdfs.child_folders(spark, f"{base}/{name}") if v.startswith("v-")]
    for old in versions[:-keep]:
        hdfs.delete_folder(spark, f"{base}/{name}/{old}")
    return counted.get["n"]


def read_published(spark: SparkSession, base: str, name: str) -> DataFrame:
    version = hdfs.read_small(spark, f"{base}/{name}/{_POINTER}")
    return spark.read.parquet(f"{base}/{name}/{version}")


def publish_jdbc(df: DataFrame, url: str, table: str, columns: Sequence[str], properties: dict[str, str]) -> None:
    """Replace the rows of a database table, keeping its definition."""
    options = df.select(*columns).write.mode("overwrite").option("truncate", True).option("batchsize", 10_000)
    options.jdbc(url, table, properties=properties)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merge_buckets(
    changes: DataFrame,
    path: str,
    key: str,
    update: Sequence[str],
    stamps: dict[str, Column] | None = None,
    buckets: int = 64,
) -> None:
    """Upsert ``changes`` into the table at ``path``, laid out in ``buckets`` by hash of key.

    Only buckets that a change falls into are read and rewritten; keep ``buckets`` the same for
    the life of a table. The new content of those buckets is first written to the shared
    folder, so a failed overwrite can be repeated. Files are sorted by key, for scans that look
    for a few keys. A NULL key is an error, as it would be for
    a primary key. The list of touched buckets, at most ``buckets`` numbers, is collected.
    """
    spark = changes.sparkSession
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{key} must not be null"))).otherwise(F.col(key))
    incoming = changes.withColumn(key, checked)
    if hdfs.exists(spark, path):
        touched = [r.bucket for r in incoming.select(_bucket(key, buckets).alias("bucket")).distinct().collect()]
        if not touched:
            return
        current = spark.read.parquet(path).where(F.col("bucket").isin(touched)).drop("bucket")
        incoming = upsert_by_key(current, incoming, key, update, stamps)
    else:
        incoming = incoming.withColumns(stamps or {})
    placed = incoming.withColumn("bucket", _bucket(key, buckets)).hint("rebalance", "bucket")
    (
        materialise(placed, "merge")
        .sortWithinPartitions("bucket", key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(path)
    )
