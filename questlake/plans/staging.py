"""Staging: the latest version of each raw document, as typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.functions.variant import Field, cast_failures, field, has_key
from questlake.operators.dedup import latest_by_key

# Output column, document path and type.
GAMES = (
    Field("game_id", "$.id", "bigint"),
    Field("name", "$.name", "string"),
    Field("slug", "$.slug", "string"),
    Field("released_date", "$.released", "date"),
    Field("rating", "$.rating", "double"),
    Field("rating_top", "$.rating_top", "int"),
    Field("ratings_count", "$.ratings_count", "int"),
    Field("metacritic_score", "$.metacritic", "int"),
    Field("avg_playtime_hours", "$.playtime", "int"),
    Field("suggestions_count", "$.suggestions_count", "int"),
    Field("esrb_rating", "$.esrb_rating.name", "string"),
    Field("background_image_url", "$.background_image", "string"),
    Field("description_raw", "$.description_raw", "string"),
    Field("genres_raw", "$.genres", "variant"),
    Field("platforms_raw", "$.platforms", "variant"),
)


def lookup_fields(key: str) -> tuple[Field, ...]:
    """Fixed values as above, for the two lookups."""
    return (
        Field(key, "$.id", "bigint"),
        Field("name", "$.name", "string"),
        Field("slug", "$.slug", "string"),
        Field("games_count", "$.games_count", "bigint"),
    )


GENRES = lookup_fields("genre_id")
PLATFORMS = lookup_fields("platform_id")


def extract(docs: DataFrame, fields: Sequence[Field], strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The typed columns of each document, plus the columns named in ``keep``."""
    return docs.select(*[field(F.col("raw_data"), f, strict).alias(f.name) for f in fields], *keep)


def _bad_key(fields: Sequence[Field]) -> Column:
    """Whether the key holds a value that does not cast. A missing key and a JSON null hold none; both are
    told from the variant that tells whether there is a key, so that a scan reads the key in two types only."""
    raw, key = F.col("raw_data"), fields[0]
    value = F.variant_get(raw, key.path, "variant")
    return field(raw, key, strict=False).isNull() & value.isNotNull() & ~F.is_variant_null(value)


def key_rejects(raw: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """The documents whose key does not cast."""
    return raw.where(_bad_key(fields))


def latest(
    raw: DataFrame,
    fields: Sequence[Field],
    version: str = "loaded_at",
    ties: Sequence[Column] = (),
    strict: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The latest document per key (the first field), typed, with the columns of ``raw`` named in ``keep``.

    Columns are extracted before the shuffle, so it carries what the reader of the result
    selects and not whole documents. With ``strict`` a value that does not cast raises, but
    only in a document that is the latest of its key; a key that does not cast raises in any.
    Without it such values are NULL, and documents with such a key are left to ``key_rejects``.
    ``ties`` may name columns of ``raw``.
    """
    key = fields[0].name
    keyed = raw.where(has_key(F.col("raw_data"), fields[0].path))
    if not strict:
        keyed = keyed.where(~_bad_key(fields))
    carried = [c for c in raw.columns if c != "raw_data" and c not in {f.name for f in fields}]
    typed = keyed.select(*[field(F.col("raw_data"), f, strict=False).alias(f.name) for f in fields], *carried, "raw_data")
    if strict:
        wrong = F.raise_error(F.concat(F.lit(f"values that do not cast: {key} "), F.variant_get("raw_data", fields[0].path, "variant").cast("string")))
        typed = typed.withColumn(key, F.when(_bad_key(fields), wrong).otherwise(F.col(key)))
        typed = typed.withColumn("_failed", cast_failures(F.col("raw_data"), fields))
    rows = latest_by_key(typed.drop("raw_data"), [key], F.col(version), ties)
    if strict:
        message = F.concat(F.lit("values that do not cast: "), F.col("_failed"))
        rows = rows.withColumn(key, F.when(F.col("_failed") != "", F.raise_error(message)).otherwise(F.col(key)))
    return rows.select(*[f.name for f in fields], *keep)


def stg_games(raw: DataFrame, ties: Sequence[Column] = (), strict: bool = True) -> DataFrame:
    return latest(raw, GAMES, ties=ties, strict=strict).withColumn("dbt_loaded_at", F.current_timestamp())


def stg_genres(raw: DataFrame, ties: Sequence[Column] = (), strict: bool = True) -> DataFrame:
    return latest(raw, GENRES, ties=ties, strict=strict)


def stg_platforms(raw: DataFrame, ties: Sequence[Column] = (), strict: bool = True) -> DataFrame:
    return latest(raw, PLATFORMS, ties=ties, strict=strict)
