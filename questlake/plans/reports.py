"""Named reports over the marts, and results as JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns, order and row limits of the reports.
GAME_COUNT_COLUMNS = [
    "total_games", "games_with_description", "games_with_rating", "avg_rating", "games_with_metacritic",
    "avg_metacritic",
]


def daily_release_counts(mart: DataFrame) -> DataFrame:
    columns = ["released_date", "games_released", "rolling_7day_release_count", "cumulative_release_count"]
    return mart.select(*columns).orderBy(F.desc_nulls_first("released_date")).limit(90)


def genre_trends(mart: DataFrame) -> DataFrame:
    """Equal (year, rating) pairs are ordered by name, which the mart's own order leaves open."""
    columns = ["genre_name", "release_year", "game_count", "avg_user_rating", "avg_metacritic"]
    order = [F.desc_nulls_first("release_year"), F.desc_nulls_first("avg_user_rating"), F.asc("genre_name")]
    return mart.select(*columns).orderBy(*order).limit(200)


def game_count(mart: DataFrame) -> DataFrame:
    return mart.select(*GAME_COUNT_COLUMNS)


def top_games(mart: DataFrame) -> DataFrame:
    columns = ["name", "rating", "metacritic_score", "combined_score", "overall_rank"]
    return mart.select(*columns).orderBy("overall_rank").limit(20)


# Report name to the mart it reads and its query.
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "daily_release_counts": ("mart_daily_release_counts", daily_release_counts),
    "genre_trends": ("mart_genre_trends", genre_trends),
    "game_count": ("mart_catalog_stats", game_count),
    "top_games": ("mart_top_games", top_games),
}


def report(read_mart: Callable[[str], DataFrame], name: str = "top_games") -> DataFrame:
    """The report ``name``; ``read_mart`` maps a mart's name to its table, from whichever copy
    of the marts is to be read. An unknown name raises with the names there are."""
    if name not in REPORTS:
        raise ValueError(f"no report is named {name!r}; there are {', '.join(REPORTS)}")
    mart, query = REPORTS[name]
    return query(read_mart(mart))


def json_rows(df: DataFrame, output: str = "json") -> DataFrame:
    """Each row as a JSON object: lower-case keys, NULLs kept, dates, times and decimals as text."""
    as_text = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
    values = [
        (F.col(f.name).cast("string") if isinstance(f.dataType, as_text) else F.col(f.name)).alias(f.name.lower())
        for f in df.schema.fields
    ]
    return df.select(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}).alias(output))
