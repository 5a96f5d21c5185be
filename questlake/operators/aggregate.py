"""Catalog statistics, trends over nested names, ordered string aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.functions.bound import bound, free_name
from questlake.functions.numeric import SCALE, rounded_avg


def catalog_stats(
    df: DataFrame, counted: dict[str, str], averaged: dict[str, tuple[str, int]], total: str, scale: int = SCALE
) -> DataFrame:
    """One row: the row count, non-null counts (output name to column) and rounded averages
    (output name to column and digits; values keep ``scale`` decimal places)."""
    return df.agg(
        F.count("*").alias(total),
        *[F.count(c).alias(name) for name, c in counted.items()],
        *[rounded_avg(F.col(c), digits, scale).alias(name) for name, (c, digits) in averaged.items()],
    )


def unnest_names(df: DataFrame, names: Column, output: str = "name") -> DataFrame:
    """One row per array element, NULL names dropped; rows with no elements give none.

    ``first_in_row`` marks the first of equal names within a row. The explode is narrow: a row
    with a long array is expanded where it lies. Its names are sorted to find the equal ones, so a
    long array costs little more than its length, and its rows come in the order of the names.
    """

    def marked(ordered: Column) -> Column:
        def mark(e: Column, i: Column) -> Column:
            return F.struct(e["name"].alias("name"), (~F.get(ordered, i - 1)["name"].eqNullSafe(e["name"])).alias("first"))

        return F.transform(ordered, mark)

    places = F.transform(names, lambda n, i: F.struct(n.alias("name"), i.alias("at")))
    return (
        df.withColumn("_element", F.explode(bound(F.array_sort(places), marked)))
        .withColumn(output, F.col("_element.name"))
        .withColumn("first_in_row", F.col("_element.first"))
        .where(F.col(output).isNotNull())
        .drop("_element")
    )


def name_trends(
    df: DataFrame,
    names: Column,
    day: str,
    key: str,
    rating: str,
    critic: str,
    name: str = "genre_name",
    min_year: int = 2000,
    unique_key: bool = False,
    scale: int = SCALE,
) -> DataFrame:
    """Per (name, release year): distinct keys, average rating and critic score, best and
    worst rating. Averages are over unnested rows, so a name listed twice weighs twice.

    ``unique_key=True`` says that no key occurs twice in ``df``: counting the first occurrence
    of a name in each row then equals the distinct count, and the shuffle carries one row per
    group and task instead of every unnested row.
    """
    dated = df.where(F.col(day).isNotNull()).withColumn("release_year", F.year(day))
    rows = unnest_names(dated.where(F.col("release_year") >= min_year), names, name)
    if unique_key:
        count = F.count(F.when(F.col("first_in_row"), F.col(key)))
    else:
        count = F.count_distinct(F.col(key))
    return rows.groupBy(name, "release_year").agg(
        count.alias("game_count"),
        rounded_avg(F.col(rating), 2, scale).alias("avg_user_rating"),
        rounded_avg(F.col(critic), 1, scale).alias("avg_metacritic"),
        F.round(F.max(rating), 2).alias("best_rating"),
        F.round(F.min(rating), 2).alias("worst_rating"),
    )


def string_agg_distinct(
    df: DataFrame, keys: Sequence[str], value: str, output: str, separator: str = ", "
) -> DataFrame:
    """Per key the distinct values in order as one string, ``''`` if there are none.

    Values are made distinct by key and value, then range partitioned on both: a hot key spreads
    over as many tasks as its values need, each of which joins a piece of them. Only the pieces meet
    per key, so no buffer holds more than one task's values and the text that is the result.
    """
    own = free_name(df, "_value")
    rows = df.select(*keys, F.col(value).cast("string").alias(own)).distinct().repartitionByRange(*keys, own)
    task, first, text = (f"{own}_{name}" for name in ("task", "first", "text"))
    values = F.array_sort(F.collect_list(own))
    pieces = rows.withColumn(task, F.spark_partition_id()).groupBy(*keys, task).agg(F.min(own).alias(first), F.array_join(values, separator).alias(text))
    ordered = F.array_sort(F.collect_list(F.when(F.col(first).isNotNull(), F.struct(first, text))))
    return pieces.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda p: p[text]), separator).alias(output))
