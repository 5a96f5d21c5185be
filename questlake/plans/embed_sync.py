"""Keeping the vector table in step with staging, and searching it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlake.functions.text import embed_text, joined_names, non_blank, preview
from questlake.functions.variant import element_strings
from questlake.operators.cells import build_cells, refresh_cells, search_cells
from questlake.operators.embed import Embedder, embedding, with_embedding
from questlake.operators.merge import pending_rows
from questlake.operators.vector import clamp_limit, cosine_topk, with_details
from questlake.session import materialise
from questlake.sources import hdfs, keyed
from questlake.sources.jsonl import load_stamp

# The columns that a sync updates, apart from vector and times.
METADATA = ["name", "description_raw", "released_date", "rating", "metacritic_score"]


def embeddable(games: DataFrame) -> DataFrame:
    """Games with a non-blank description and at least one genre entry, with ``genres`` as
    one string. The genres lie in the row itself, so nothing is shuffled."""
    names = element_strings(F.col("genres_raw"))
    rows = games.where(non_blank(F.col("description_raw"))).withColumn("_names", names).where(F.size("_names") > 0)
    return rows.select("game_id", *METADATA, joined_names(F.col("_names")).alias("genres"))


def pending_games(games: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Embeddable games with no stored vector. ``embedded_at`` is set together with the vector
    and is read in its place, as it is far narrower."""
    ready = embeddable(games)
    return ready if stored is None else pending_rows(ready, stored, "game_id", filled="embedded_at")


def stored_vectors(spark: SparkSession, store: str) -> DataFrame | None:
    """The vector table, or None before the first sync."""
    return keyed.read_keyed(spark, store) if keyed.manifest(spark, store) else None


def sync_embeddings(
    games: DataFrame,
    store: str,
    embed: Embedder,
    now: dt.datetime | None = None,
    buckets: int = 64,
    partitions: int | None = None,
    index: str | None = None,
) -> dict[str, object]:
    """Embed the pending games and merge them into the vector table at ``store``; with
    ``index``, bring the cell index there up to date.

    ``store`` is a keyed table (``read_keyed``). Stored vectors are never refreshed. Metadata and vector are
    merged in one commit, after the vectors were computed once; a run that fails before leaves the table as it
    was, and a run with few new games writes few files.
    """
    spark = games.sparkSession
    stored = stored_vectors(spark, store)
    text = embed_text(F.col("name"), F.col("genres"), F.col("description_raw"))
    pending = with_embedding(pending_games(games, stored), text, embed, partitions=partitions)
    ready = materialise(pending.drop("genres"), "embedded")
    count = ready.count()
    if count:
        stamp = load_stamp(now)
        keyed.upsert(ready, store, "game_id", [*METADATA, "embedding"], {"synced_at": stamp, "embedded_at": stamp}, buckets)
        stored = stored_vectors(spark, store)
    if index and stored is not None:
        update = refresh_cells if hdfs.exists(spark, f"{index}/cells") else build_cells
        update(stored, index, "game_id")
    return {"status": "ok", "embedded": count, "skipped": 0}


def embed_query(spark: SparkSession, text: str, embed: Embedder) -> list[float]:
    """The vector of a search text."""
    if not text or not text.strip():
        raise ValueError("the search text is blank")
    row = spark.range(1).select(embedding(F.lit(text.strip()), embed, "query").alias("v")).first()
    return list(row.v)


def search(table: DataFrame, query: Sequence[float], limit: object = None, index: str | None = None) -> DataFrame:
    """The games nearest to the query vector, nearest first, with a preview of the text. With
    the cell index of the table, only cells that can hold a hit are read; the hits are the same."""
    k = clamp_limit(limit)
    if index:
        hits = search_cells(table.sparkSession, index, query, k, "game_id")
    else:
        hits = cosine_topk(table, query, k, "game_id")
    return (
        with_details(hits, table, "game_id")
        .select(
            "game_id",
            "name",
            "released_date",
            "rating",
            "metacritic_score",
            preview(F.col("description_raw")).alias("description_preview"),
            "similarity",
        )
        .orderBy(F.desc("similarity"), "game_id")
    )
