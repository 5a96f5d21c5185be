"""The jobs a user runs: ingest, staging, marts, gate, publish, embed, and all in order."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from questlake.functions.variant import has_key
from questlake.operators import quality
from questlake.operators.dedup import latest_by_key
from questlake.operators.embed import Embedder
from questlake.operators.merge import enrich_merge
from questlake.operators.quality import Tests
from questlake.operators.validate import split_window, window_bounds
from questlake.plans import marts, staging
from questlake.plans.embed_sync import sync_embeddings
from questlake.plans.staged import read_staged, stage_new_batches
from questlake.session import materialise
from questlake.sources import keyed
from questlake.sources.jsonl import entity_path, read_raw, write_bronze
from questlake.sources.pages import page_results
from questlake.sources.retention import drop_expired
from questlake.sources.snapshots import publish, read_published
from questlake.streaming.incremental import load_new_files, read_raw_table

ENTITIES = ("games", "genres", "platforms")

# The declared tests of each model.
TESTS = {
    "stg_games": Tests(unique=["game_id"], not_null=["game_id", "name"]),
    "stg_genres": Tests(unique=["genre_id"], not_null=["genre_id"]),
    "stg_platforms": Tests(unique=["platform_id"], not_null=["platform_id"]),
    "mart_top_games": Tests(
        unique=["game_id", "overall_rank"], not_null=["game_id", "combined_score", "overall_rank"]
    ),
    "mart_genre_trends": Tests(not_null=["genre_name", "release_year"]),
    "mart_daily_release_counts": Tests(
        unique=["released_date"],
        not_null=["released_date", "games_released", "rolling_7day_release_count", "cumulative_release_count"],
    ),
    "mart_catalog_stats": Tests(not_null=["total_games"]),
}


def _id() -> Column:
    return F.try_variant_get("raw_data", "$.id", "bigint")


def fetched_games(pages: DataFrame, details: DataFrame, as_of: dt.date | None = None, days: int = 7) -> DataFrame:
    """Records of the landed pages, in the release window, overlaid with their details.

    ``details`` may hold a document more than once: the latest load counts, of one load the file
    whose path comes last, which is the newest where files lie in folders by date.
    """
    records = page_results(pages)
    released = F.try_variant_get("raw_data", "$.released", "string")
    accepted, _ = split_window(records, released, as_of, days)
    keyed = details.where(has_key(F.col("raw_data"), "$.id")).withColumn("_id", _id())
    ties = [F.col("source_file").desc()] if "source_file" in details.columns else []
    ties += [F.xxhash64(F.to_json("raw_data")).asc()]
    one_each = latest_by_key(keyed, ["_id"], F.col("loaded_at"), ties)
    return enrich_merge(accepted.withColumn("_id", _id()), one_each, "_id").drop("_id")


def ingest(
    spark: SparkSession, landing: str, bronze: str, as_of: dt.date | None = None, days: int = 7, run: dt.date | None = None
) -> dict[str, int]:
    """From landed files to bronze: ``landing`` holds ``games``, ``genres`` and ``platforms``
    pages and game ``details``, each in a folder per run date below if ``run`` is given; only the
    files of that run are then read. Writes the partition of the window's last day; returns counts."""
    _, end = window_bounds(as_of, days)
    landed = lambda entity: entity_path(landing, entity) + (f"/{run}" if run else "")
    pages = {e: read_raw(spark, landed(e)) for e in ENTITIES}
    details = read_raw(spark, landed("details"))
    docs = {e: page_results(pages[e]) for e in ENTITIES if e != "games"}
    docs["games"] = fetched_games(pages["games"], details, end, days)
    counts = {}
    for entity in ENTITIES:
        counted = Observation()
        rows = docs[entity].withColumn("ingest_date", F.lit(end)).observe(counted, F.count(F.lit(1)).alias("n"))
        write_bronze(rows, bronze, entity)
        counts[entity] = counted.get["n"]
    return counts


def build_staging(raw: dict[str, DataFrame], base: str, ties: tuple[Column, ...] = ()) -> dict[str, DataFrame]:
    """Stage the three entities and store them once, as four marts and the embedding read them."""
    spark = raw["games"].sparkSession
    staged = {
        "stg_games": staging.stg_games(raw["games"], ties),
        "stg_genres": staging.stg_genres(raw["genres"], ties),
        "stg_platforms": staging.stg_platforms(raw["platforms"], ties),
    }
    for name, df in staged.items():
        publish(df, base, name, df.columns)
    return {name: read_published(spark, base, name) for name in staged}


def update_staging(spark: SparkSession, raw: str, base: str, buckets: int = 64) -> dict[str, DataFrame]:
    """Stage what came to the three raw tables below ``raw`` since the last run, into keyed tables."""
    models = {"stg_games": ("games", staging.GAMES), "stg_genres": ("genres", staging.GENRES), "stg_platforms": ("platforms", staging.PLATFORMS)}
    staged = {}
    for name, (entity, fields) in models.items():
        stamp = "dbt_loaded_at" if name == "stg_games" else None
        stage_new_batches(spark, f"{raw}/{entity}", f"{base}/{name}", fields, stamp=stamp, buckets=buckets)
        if keyed.manifest(spark, f"{base}/{name}"):
            staged[name] = read_staged(spark, f"{base}/{name}")
        else:
            empty = staging.latest(read_raw_table(spark, f"{raw}/{entity}"), fields)
            staged[name] = empty.withColumn(stamp, F.current_timestamp()) if stamp else empty
    return staged


def build_marts(games: DataFrame, base: str) -> dict[str, DataFrame]:
    for name, build in marts.MARTS.items():
        publish(build(games), base, name, marts.COLUMNS[name])
    return {name: read_published(games.sparkSession, base, name) for name in marts.MARTS}


def publish_marts(tables: dict[str, DataFrame], base: str) -> dict[str, int]:
    """Full refresh of the mirror tables; returns their row counts."""
    return {name: publish(tables[name], base, name, columns) for name, columns in marts.COLUMNS.items()}


def run_all(
    spark: SparkSession,
    bronze: str,
    out: str,
    embed: Embedder,
    loaded_at: dt.datetime | None = None,
    buckets: int = 64,
    partitions: int | None = None,
    index: str | None = None,
    retain: tuple[dt.date, int] | None = None,
) -> dict[str, object]:
    """Load new bronze files, stage them, build the marts, test, then embed and publish.

    Staging reads the new raw rows and merges them into the stored ones. Equal load times are decided by file name and the hash of the line. A failing test raises
    ``DataQualityError`` before anything is embedded or published. These two run side by side, and
    one that fails does not stop the other: its error is raised when both have ended. ``buckets``,
    ``partitions`` and ``index`` are those of ``sync_embeddings``, and ``buckets`` that of staging too; with ``retain``, a date and a
    number of days, bronze folders older than that are deleted in the end.
    """
    loaded, rejected = {}, {}
    for entity in ENTITIES:
        target = f"{out}/raw/{entity}"
        loaded[entity], rejected[entity] = load_new_files(
            spark, entity_path(bronze, entity), target, f"{out}/checkpoints/{entity}", loaded_at
        )
    staged = update_staging(spark, f"{out}/raw", f"{out}/staging", buckets)
    built = build_marts(staged["stg_games"], f"{out}/mart")
    result = materialise(quality.summary({**staged, **built}, TESTS), "tests")
    quality.require_clean(result)
    with ThreadPoolExecutor(2) as both:
        embedded = both.submit(sync_embeddings, staged["stg_games"], f"{out}/vectors", embed, loaded_at, buckets, partitions, index)
        published = both.submit(publish_marts, built, f"{out}/published")
    outcome = {"loaded": loaded, "rejected": rejected, "tests": result.count(),
               "published": published.result(), "embedded": embedded.result()["embedded"]}
    if retain:
        for entity in ENTITIES:
            drop_expired(spark, entity_path(bronze, entity), *retain)
    return outcome
