"""Staging kept up to date: each run reads the raw batches that came since the last one.

The staged rows are a keyed table with one row per key, together with what decides which version is the latest.
New documents are cut to the latest per key, met with the stored rows of those keys only, and the winners are
merged in. The number of the last batch is committed with the rows, so a run that dies is simply run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlake.functions.variant import Field
from questlake.operators.dedup import latest_by_key
from questlake.plans.staging import latest
from questlake.session import materialise
from questlake.sources import keyed
from questlake.streaming.incremental import batches, read_raw_table

#: What decides between versions of a key, as in a full staging run: the load, then file and line.
VERSION = ("loaded_at", "source_file", "line_hash")
#: The table's key: the document's as text, '' if it is null. A key of documents may be null, one of a table not.
KEY = "stage_key"


def _ties() -> list[Column]:
    return [F.desc("source_file"), F.asc("line_hash")]


def stage_new_batches(
    spark: SparkSession, raw: str, store: str, fields: Sequence[Field], strict: bool = True, stamp: str | None = None, buckets: int = 64
) -> dict[str, int]:
    """Bring the staged table at ``store`` up to date with the raw table at ``raw``; returns the counts of batches
    read, keys inserted and keys updated.

    The result is that of ``latest`` over all raw rows. With ``strict`` a value that does not cast raises if its
    document is the latest of its key among the new ones. ``stamp`` names a column for the time of staging.
    """
    through = keyed.notes(spark, store).get("through", -1)
    new = batches(spark, raw, through)
    if not new:
        return {"batches": 0, "inserted": 0, "updated": 0}
    key = F.coalesce(F.col(fields[0].name).cast("string"), F.lit(""))
    rows = latest(read_raw_table(spark, raw, through), fields, ties=_ties(), strict=strict, keep=VERSION)
    rows = materialise(rows.withColumn(KEY, key), "staged")
    if keyed.manifest(spark, store):
        met = keyed.read_keyed(spark, store).select(*rows.columns).join(rows.select(KEY), KEY, "left_semi")
        both = rows.withColumn("_new", F.lit(True)).unionByName(met.withColumn("_new", F.lit(False)))
        rows = latest_by_key(both, [KEY], F.col("loaded_at"), [*_ties(), F.col("_new")]).where("_new").drop("_new")
    update = [c for c in rows.columns if c != KEY]
    stamps = {stamp: F.current_timestamp()} if stamp else None
    changed = keyed.upsert(rows, store, KEY, update, stamps, buckets, notes={"through": new[-1]})
    return {"batches": len(new), "inserted": changed.inserted, "updated": changed.updated}


def read_staged(spark: SparkSession, store: str) -> DataFrame:
    """The staged rows, without what the merge keeps for itself."""
    return keyed.read_keyed(spark, store).drop(KEY, *VERSION)
