"""JSON lines: one document per line, in folders by entity and date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlake.functions.variant import element_names, lenient_date


def read_lines(spark: SparkSession, paths: str | Sequence[str], dated: bool = False) -> DataFrame:
    """``value`` and the ``source_file`` it came from, plus partition columns of the path.

    ``dated=True`` reads plain date folders (``games/2026-06-13/data.jsonl``), which Spark does
    not take for partitions, and takes ``ingest_date`` from the path. To read some dates only,
    give their folders.
    """
    reader = spark.read.option("recursiveFileLookup", "true") if dated else spark.read
    lines = reader.text(paths).withColumn("source_file", F.col("_metadata.file_path"))
    if not dated:
        return lines
    day = F.regexp_extract("source_file", r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return lines.withColumn("ingest_date", lenient_date(day))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``raw_data``: the line as a variant, NULL if it is not valid JSON. Blank lines go."""
    return lines.where(F.trim("value") != "").withColumn("raw_data", F.try_parse_json("value"))


def load_stamp(loaded_at: dt.datetime | None) -> Column:
    """One load time for the whole load: the given one, for a replay, or the current. A time
    without a zone is in the session's zone, wherever the driver runs."""
    if loaded_at is None:
        return F.current_timestamp()
    return F.lit(str(loaded_at)).cast("timestamp")


def read_raw(
    spark: SparkSession, paths: str | Sequence[str], loaded_at: dt.datetime | None = None, dated: bool = False
) -> DataFrame:
    """The valid documents as ``raw_data`` with ``loaded_at``; malformed lines are skipped."""
    parsed = parse_lines(read_lines(spark, paths, dated)).where(F.col("raw_data").isNotNull())
    return parsed.drop("value").withColumn("loaded_at", load_stamp(loaded_at))


def read_rejects(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The malformed lines, for inspection."""
    return parse_lines(read_lines(spark, paths)).where(F.col("raw_data").isNull()).drop("raw_data")


def entity_path(base: str, entity: str) -> str:
    return f"{base.rstrip('/')}/{entity}"


def write_bronze(docs: DataFrame, base: str, entity: str, doc: str = "raw_data", compact: bool = False) -> None:
    """Write one JSON document per line under ``base/entity/ingest_date=YYYY-MM-DD``.

    Dates present in ``docs`` are replaced, others stay; no rows, no change. Tasks write what
    they hold, without a shuffle. ``compact=True`` first gathers each date into few files;
    Spark splits a date that is too large for one task.
    """
    lines = docs.select(F.to_json(doc).alias("value"), "ingest_date")
    if compact:
        lines = lines.hint("rebalance", "ingest_date")
    (
        lines.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date")
        .text(entity_path(base, entity))
    )


def preview(docs: DataFrame, n: int = 2, doc: str = "raw_data") -> DataFrame:
    """The first ``n`` documents with the names of their genres and platforms."""
    raw = F.col(doc)

    def text(key: str) -> Column:
        return F.variant_get(raw, f"$.{key}", "string").alias(key)

    return docs.limit(n).select(
        F.variant_get(raw, "$.id", "bigint").alias("id"),
        text("name"),
        text("released"),
        F.variant_get(raw, "$.rating", "double").alias("rating"),
        F.variant_get(raw, "$.metacritic", "int").alias("metacritic"),
        element_names(F.variant_get(raw, "$.genres", "variant")).alias("genres"),
        element_names(F.variant_get(raw, "$.platforms", "variant"), "$.platform.name").alias("platforms"),
    )


def load_summary(docs: DataFrame, text_path: str = "$.description_raw") -> DataFrame:
    """Per ``entity``: documents, and documents with a non-empty text at ``text_path``."""
    text = F.try_variant_get("raw_data", text_path, "string")
    return docs.groupBy("entity").agg(
        F.count("*").alias("loaded"), F.count_if(text.isNotNull() & (text != "")).alias("described")
    )
