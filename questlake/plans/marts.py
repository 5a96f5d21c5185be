"""The four marts. Each takes staged games, which hold one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlake.functions.numeric import weighted_score
from questlake.functions.variant import element_strings
from questlake.operators import aggregate, series
from questlake.operators.rank import rank_rows

# The columns of the published tables, in order.
COLUMNS = {
    "mart_top_games": [
        "game_id", "name", "released_date", "release_year", "rating", "metacritic_score", "ratings_count",
        "avg_playtime_hours", "esrb_rating", "background_image_url", "combined_score", "overall_rank",
        "rank_in_year",
    ],
    "mart_genre_trends": [
        "genre_name", "release_year", "game_count", "avg_user_rating", "avg_metacritic", "best_rating",
        "worst_rating",
    ],
    "mart_daily_release_counts": [
        "released_date", "games_released", "avg_rating_that_day", "games_with_metacritic",
        "rolling_7day_release_count", "cumulative_release_count",
    ],
    "mart_catalog_stats": [
        "total_games", "games_with_description", "games_with_rating", "games_with_metacritic", "avg_rating",
        "avg_metacritic",
    ],
}


def scored_games(games: DataFrame) -> DataFrame:
    """Games that have both scores, with their year and combined score."""
    rated = games.where(F.col("rating").isNotNull() & F.col("metacritic_score").isNotNull())
    return rated.withColumns(
        {
            "release_year": F.year("released_date"),
            "combined_score": weighted_score(F.col("metacritic_score"), F.col("rating")),
        }
    ).select(*COLUMNS["mart_top_games"][:-2])


def mart_top_games(games: DataFrame) -> DataFrame:
    """Both ranks from one range sort; games without a date share the NULL year."""
    order = [F.desc_nulls_first("combined_score"), F.asc_nulls_last("game_id")]
    return rank_rows(scored_games(games), order, overall="overall_rank", within={"rank_in_year": ["release_year"]})


def mart_genre_trends(games: DataFrame, min_year: int = 2000) -> DataFrame:
    return aggregate.name_trends(
        games,
        element_strings(F.col("genres_raw")),
        day="released_date",
        key="game_id",
        rating="rating",
        critic="metacritic_score",
        min_year=min_year,
        unique_key=True,
    )


def mart_daily_release_counts(games: DataFrame) -> DataFrame:
    daily = series.daily_counts(
        games,
        day="released_date",
        key="game_id",
        counted="games_released",
        averaged="rating",
        scored="metacritic_score",
        average="avg_rating_that_day",
        scored_count="games_with_metacritic",
        unique_key=True,
    )
    return series.running_sums(
        daily, "released_date", "games_released", "rolling_7day_release_count", "cumulative_release_count"
    )


def mart_catalog_stats(games: DataFrame) -> DataFrame:
    return aggregate.catalog_stats(
        games,
        counted={
            "games_with_description": "description_raw",
            "games_with_rating": "rating",
            "games_with_metacritic": "metacritic_score",
        },
        averaged={"avg_rating": ("rating", 2), "avg_metacritic": ("metacritic_score", 1)},
        total="total_games",
    )


MARTS = {
    "mart_top_games": mart_top_games,
    "mart_genre_trends": mart_genre_trends,
    "mart_daily_release_counts": mart_daily_release_counts,
    "mart_catalog_stats": mart_catalog_stats,
}
