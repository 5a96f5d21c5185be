"""Append-only loads that take each file once, with a log of what each batch brought.

The raw table has a folder per micro-batch, ``batch=<n>``. A batch that is run again after a failure replaces
its folder and its entry in the log, so it counts once. Counts come from the log alone, and a reader that has
seen the table up to a batch reads the folders of later batches only.
"""

from __future__ import annotations

import datetime as dt
import json
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from questlake.session import shredded_variants
from questlake.sources import hdfs
from questlake.sources.jsonl import load_stamp

RAW_SCHEMA = "raw_data variant, loaded_at timestamp, source_file string, line_hash bigint, rejected string"
LOAD_SCHEMA = "batch bigint, loaded_at string, loaded bigint, rejected bigint"
_LOADS = "_loads"


class Loaded(NamedTuple):
    """What a load appended: documents, and malformed lines."""

    loaded: int
    rejected: int


def _entry(target: str, batch: int) -> str:
    return f"{target}/{_LOADS}/{batch:020d}.json"


def batches(spark: SparkSession, target: str, after: int = -1) -> list[int]:
    """Numbers of the batches that were loaded, in order, from the one after ``after`` on."""
    names = hdfs.child_files(spark, f"{target}/{_LOADS}")
    return [n for n in (int(name.partition(".")[0]) for name in names if name.endswith(".json")) if n > after]


def load_log(spark: SparkSession, target: str) -> DataFrame:
    """A row per batch: ``batch, loaded_at, loaded, rejected``."""
    if not hdfs.exists(spark, f"{target}/{_LOADS}"):
        return spark.createDataFrame([], LOAD_SCHEMA)
    return spark.read.schema(LOAD_SCHEMA).option("pathGlobFilter", "*.json").json(f"{target}/{_LOADS}")


def load_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    loaded_at: dt.datetime | None = None,
    files_per_batch: int = 10_000,
) -> Loaded:
    """Append the documents of files not yet loaded to the raw table at ``target``.

    A file stream with ``availableNow`` runs until all files present are loaded, in batches of
    ``files_per_batch``, and stops. The checkpoint knows each loaded file. All batches of a load have one load
    time, taken before it starts. Malformed lines go to the same table, in ``rejected``. Returns how many of
    both were appended, as observed while they were written: the table is not read.
    A source folder that does not exist yet has no files.
    """
    if not hdfs.exists(spark, source):
        return Loaded(0, 0)
    known = batches(spark, target)
    stamp = loaded_at or dt.datetime.now(dt.timezone.utc)
    lines = (
        spark.readStream.schema("value string")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(source)
    )
    parsed = lines.where(F.trim("value") != "").select(
        F.try_parse_json("value").alias("raw_data"),
        load_stamp(stamp).alias("loaded_at"),
        F.col("_metadata.file_path").alias("source_file"),
        F.xxhash64("value").alias("line_hash"),
        "value",
    )
    docs = parsed.withColumn("rejected", F.when(F.col("raw_data").isNull(), F.col("value"))).drop("value")

    def append(rows: DataFrame, batch: int) -> None:
        counted = Observation()
        seen = rows.observe(counted, F.count(F.lit(1)).alias("n"), F.count("rejected").alias("bad"))
        seen.write.mode("overwrite").parquet(f"{target}/batch={batch}")
        n, bad = counted.get["n"], counted.get["bad"]
        entry = {"batch": batch, "loaded_at": str(stamp), "loaded": n - bad, "rejected": bad}
        hdfs.replace_small(spark, _entry(target, batch), json.dumps(entry))

    with shredded_variants(spark):
        query = docs.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    entries = [json.loads(hdfs.read_small(spark, _entry(target, b))) for b in batches(spark, target, max(known, default=-1))]
    return Loaded(sum(e["loaded"] for e in entries), sum(e["rejected"] for e in entries))


def _rows(spark: SparkSession, target: str, after: int = -1) -> DataFrame:
    """The rows of the batches after ``after``. Only their folders are listed and read."""
    folders = [f"{target}/batch={b}" for b in batches(spark, target, after)]
    if not folders:
        return spark.createDataFrame([], RAW_SCHEMA)
    return spark.read.schema(RAW_SCHEMA).parquet(*folders)


def read_raw_table(spark: SparkSession, target: str, after: int = -1) -> DataFrame:
    """The raw table written by ``load_new_files``, or what came ``after`` a batch; empty if nothing was loaded."""
    return _rows(spark, target, after).where("rejected IS NULL").drop("rejected")


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """The malformed lines that loads met: ``value``, ``loaded_at`` and ``source_file``."""
    rows = _rows(spark, target).where("rejected IS NOT NULL")
    return rows.select(F.col("rejected").alias("value"), "loaded_at", "source_file")
