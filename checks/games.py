"""Catalog queries: each line item is one load of the record of its part.

The records are built as variants by Spark from ``lineitem`` and ``part`` and go through the
library's staging, marts, reports and jobs; the SQL is written on the tables' columns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query, table
from questlake.functions.text import joined_names
from questlake.functions.variant import element_names, element_strings
from questlake.operators import aggregate, quality
from questlake.operators.dedup import latest_by_key
from questlake.operators.embed import hashed_words
from questlake.plans import marts, reports, staging
from questlake.plans.embed_sync import embed_query, embeddable, search, sync_embeddings
from questlake.plans.jobs import TESTS, ingest, run_all
from questlake.session import materialise, new_dir
from questlake.sources.jsonl import preview, read_raw, write_bronze
from questlake.sources.keyed import read_keyed
from questlake.sources.snapshots import publish, read_published

# Which of the loads of one part is the latest: ship date, then these.
_TIES = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows, one per load. They are built where they are read: writing them as shredded variants takes
    longer than building them again, and no query reads them more than twice."""
    return game_documents(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


def game_documents(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """A document per line item. The narrow line items are dealt over tasks by part, in shuffle partitions of the
    size that Spark aims at, so that what sorts the wide documents does so in memory."""
    rows = lines.hint("rebalance", "l_partkey").join(parts, F.expr("l_partkey = p_partkey"))
    line = F.col("l_linenumber")

    def named(value: Column | str) -> Column:
        return F.struct(F.col(value).alias("name") if isinstance(value, str) else value.alias("name"))

    document = F.struct(
        F.col("l_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("slug"),
        F.when(line == 6, "TBA").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("released"),
        F.when(line != 5, F.col("l_quantity") / 10).alias("rating"),
        F.lit(5).alias("rating_top"),
        F.col("l_suppkey").alias("ratings_count"),
        F.when(line != 7, F.round(F.col("l_discount") * 1000).cast("int")).alias("metacritic"),
        F.col("p_size").alias("playtime"),
        line.alias("suggestions_count"),
        F.when(F.col("l_linestatus") == "O", named("l_returnflag")).alias("esrb_rating"),
        F.col("p_brand").alias("background_image"),
        F.when(line == 4, "  ").when(line != 3, F.concat_ws(" ", "p_name", "p_brand")).alias("description_raw"),
        F.when(line != 2, F.array(named("p_type"), named("p_brand"), named(F.lit(None).cast("string")))).alias("genres"),
        F.array(F.struct(named("l_linestatus").alias("platform")), F.lit(None)).alias("platforms"),
    )
    # Not deterministic to the optimiser, which would build the document again for each filter that it moves down.
    once = F.when(F.monotonically_increasing_id() >= 0, F.to_variant_object(document))
    return rows.select(once.alias("raw_data"), F.col("l_shipdate").alias("loaded_at"), *_TIES)


def staged_games(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Staging; with ``status``, as it stood when only the loads of that status had come in."""
    raw = raw_games(spark, sf_dir)
    if status:
        raw = raw.where(F.variant_get("raw_data", "$.platforms[0].platform.name", "string") == status)
    return staging.stg_games(raw, ties=[F.desc(c) for c in _TIES])


def _staged_sql(name: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
      SELECT l_partkey AS game_id, p_name AS name, p_type AS slug,
        CASE WHEN l_linenumber <> 6 THEN CAST(l_shipdate AS DATE) END AS released_date,
        CASE WHEN l_linenumber <> 5 THEN l_quantity / 10 END AS rating,
        CASE WHEN l_linenumber <> 5 THEN CAST(round(l_quantity) AS BIGINT) END AS tenths,
        5 AS rating_top, CAST(l_suppkey AS INTEGER) AS ratings_count,
        CASE WHEN l_linenumber <> 7 THEN CAST(round(l_discount * 1000) AS INTEGER) END AS metacritic_score,
        p_size AS avg_playtime_hours, l_linenumber AS suggestions_count,
        CASE WHEN l_linestatus = 'O' THEN l_returnflag END AS esrb_rating, p_brand AS background_image_url,
        CASE WHEN l_linenumber = 4 THEN '  ' WHEN l_linenumber <> 3 THEN p_name || ' ' || p_brand END
          AS description_raw,
        l_linenumber <> 2 AS has_genres, p_type, p_brand, l_linestatus AS platform
      FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC NULLS FIRST,
              {", ".join(c + " DESC" for c in _TIES)}) AS rn
            FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {where}) WHERE rn = 1)"""


_STG = "WITH " + _staged_sql("stg")


def _avg(cents: str, ones: int, digits: int) -> str:
    """ROUND(AVG(x), digits), half up, in whole numbers: ``cents`` is x times ``ones``."""
    up = f"2 * sum({cents}) * {10**digits}"
    n = f"(count({cents}) * {ones})"
    return f"CASE WHEN count({cents}) > 0 THEN CAST(({up} + {n}) // (2 * {n}) AS BIGINT) / {float(10**digits)} END"


_TOP = _STG + """, scored AS (
  SELECT game_id, name, released_date, CAST(year(released_date) AS INTEGER) AS release_year, rating,
    metacritic_score, ratings_count, avg_playtime_hours, esrb_rating, background_image_url,
    round(metacritic_score / 100.0 * 5 * 0.6 + rating * 0.4, 2) AS combined_score
  FROM stg WHERE rating IS NOT NULL AND metacritic_score IS NOT NULL),
top AS (SELECT *, row_number() OVER (ORDER BY combined_score DESC, game_id) AS overall_rank,
    row_number() OVER (PARTITION BY release_year ORDER BY combined_score DESC, game_id) AS rank_in_year FROM scored)"""

_TRENDS = _STG + f""", rows AS (
  SELECT *, CAST(year(released_date) AS INTEGER) AS release_year, unnest([p_type, p_brand]) AS genre_name
  FROM stg WHERE has_genres),
trends AS (SELECT genre_name, release_year, count(DISTINCT game_id) AS game_count,
    {_avg("tenths", 10, 2)} AS avg_user_rating, {_avg("metacritic_score", 1, 1)} AS avg_metacritic,
    round(max(rating), 2) AS best_rating, round(min(rating), 2) AS worst_rating
  FROM rows WHERE genre_name IS NOT NULL AND release_year >= 2000 GROUP BY genre_name, release_year)"""

_DAILY = _STG + f""", days AS (
  SELECT released_date, count(DISTINCT game_id) AS games_released, {_avg("tenths", 10, 2)} AS avg_rating_that_day,
    count(DISTINCT CASE WHEN metacritic_score IS NOT NULL THEN game_id END) AS games_with_metacritic
  FROM stg WHERE released_date IS NOT NULL GROUP BY released_date),
daily AS (SELECT *,
    CAST(sum(games_released) OVER (ORDER BY released_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT)
      AS rolling_7day_release_count,
    CAST(sum(games_released) OVER (ORDER BY released_date ROWS UNBOUNDED PRECEDING) AS BIGINT)
      AS cumulative_release_count FROM days)"""

_STATS = _STG + f""", stats AS (
  SELECT count(*) AS total_games, count(description_raw) AS games_with_description, count(rating) AS games_with_rating,
    count(metacritic_score) AS games_with_metacritic, {_avg("tenths", 10, 2)} AS avg_rating,
    {_avg("metacritic_score", 1, 1)} AS avg_metacritic FROM stg)"""


@query(
    "stg_games",
    _STG + """ SELECT game_id, name, slug, released_date, rating, rating_top, ratings_count, metacritic_score,
      avg_playtime_hours, suggestions_count, esrb_rating, background_image_url, description_raw FROM stg""",
)
def stg_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_games(spark, sf_dir).drop("genres_raw", "platforms_raw", "dbt_loaded_at")


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier is one load of the record of its nation; all in one load, so they tie."""
    document = F.struct(
        F.col("s_nationkey").alias("id"),
        F.col("s_name").alias("name"),
        F.lower("s_name").alias("slug"),
        F.col("s_suppkey").alias("games_count"),
    )
    rows = table(spark, sf_dir, "supplier")
    return rows.select(
        F.to_variant_object(document).alias("raw_data"),
        F.lit(dt.datetime(2026, 1, 5)).alias("loaded_at"),
        "s_suppkey",
    )


_LOOKUP_SQL = """SELECT CAST(s_nationkey AS BIGINT) AS {key}, s_name AS name, lower(s_name) AS slug,
  s_suppkey AS games_count FROM (
    SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) AS rn FROM supplier) WHERE rn = 1"""


@query("stg_genres", _LOOKUP_SQL.format(key="genre_id"))
def stg_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_genres(_lookup(spark, sf_dir), ties=[F.desc("s_suppkey")])


@query("stg_platforms", _LOOKUP_SQL.format(key="platform_id"))
def stg_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_platforms(_lookup(spark, sf_dir), ties=[F.desc("s_suppkey")])


@query("mart_top_games", _TOP + " SELECT * FROM top")
def mart_top_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_top_games(staged_games(spark, sf_dir))


@query("mart_genre_trends", _TRENDS + " SELECT * FROM trends")
def mart_genre_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_genre_trends(staged_games(spark, sf_dir))


@query("mart_daily_release_counts", _DAILY + " SELECT * FROM daily")
def mart_daily_release_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_daily_release_counts(staged_games(spark, sf_dir))


@query("mart_catalog_stats", _STATS + " SELECT * FROM stats")
def mart_catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_catalog_stats(staged_games(spark, sf_dir))


def _report(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        games, base = staged_games(spark, sf_dir), new_dir(spark, "published")

        def published(mart: str) -> DataFrame:
            publish(marts.MARTS[mart](games), base, mart, marts.COLUMNS[mart])
            return read_published(spark, base, mart)

        return reports.report(published, name)

    return run


query(
    "report_top_games",
    _TOP + " SELECT name, rating, metacritic_score, combined_score, overall_rank FROM top ORDER BY overall_rank LIMIT 20",
)(_report("top_games"))
query(
    "report_genre_trends",
    _TRENDS + """ SELECT genre_name, release_year, game_count, avg_user_rating, avg_metacritic FROM trends
      ORDER BY release_year DESC NULLS FIRST, avg_user_rating DESC NULLS FIRST, genre_name LIMIT 200""",
)(_report("genre_trends"))
query(
    "report_daily_counts",
    _DAILY + """ SELECT released_date, games_released, rolling_7day_release_count, cumulative_release_count FROM daily
      ORDER BY released_date DESC LIMIT 90""",
)(_report("daily_release_counts"))
query("report_game_count", _STATS + f" SELECT {', '.join(reports.GAME_COUNT_COLUMNS)} FROM stats")(_report("game_count"))


@query(
    "report_json",
    _DAILY + """ SELECT '{"released_date":"' || CAST(released_date AS VARCHAR) || '","games_released":' || games_released
      || ',"rolling_7day_release_count":' || rolling_7day_release_count || ',"cumulative_release_count":'
      || cumulative_release_count || '}' AS json FROM (SELECT * FROM daily ORDER BY released_date DESC LIMIT 90)""",
)
def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.json_rows(_report("daily_release_counts")(spark, sf_dir))


@query("publish_catalog_stats", _STATS + " SELECT * FROM stats")
def publish_catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, base = "mart_catalog_stats", new_dir(spark, "published")
    publish(marts.mart_catalog_stats(staged_games(spark, sf_dir)), base, name, marts.COLUMNS[name])
    return read_published(spark, base, name)


@query("unnest", _STG + " SELECT game_id, unnest([p_type, p_brand]) AS genre_name FROM stg WHERE has_genres")
def unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = staged_games(spark, sf_dir)
    return aggregate.unnest_names(games, element_strings(F.col("genres_raw")), "genre_name").select("game_id", "genre_name")


@query(
    "nested_names",
    _STG + """ SELECT game_id, CASE WHEN has_genres THEN p_type || '/' || p_brand ELSE '' END AS genres,
      platform AS platforms FROM stg""",
)
def nested_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_games(spark, sf_dir).select(
        "game_id",
        F.array_join(element_names(F.col("genres_raw")), "/").alias("genres"),
        F.array_join(element_names(F.col("platforms_raw"), "$.platform.name"), "/").alias("platforms"),
    )


_GENRES = "least(p_type, p_brand) || ', ' || greatest(p_type, p_brand)"


@query("genre_list", _STG + f" SELECT game_id, {_GENRES} AS genres FROM stg WHERE has_genres")
def genre_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = element_strings(F.col("genres_raw"))
    games = staged_games(spark, sf_dir).where(F.size(names) > 0)
    return games.select("game_id", joined_names(names).alias("genres"))


@query(
    "embeddable",
    _STG + f""" SELECT game_id, name, description_raw, released_date, rating, metacritic_score, {_GENRES} AS genres
      FROM stg WHERE has_genres AND trim(description_raw) <> ''""",
)
def embeddable_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddable(staged_games(spark, sf_dir))


# The times of the first and second run below.
_FIRST, _SECOND = dt.datetime(2026, 1, 5, 3), dt.datetime(2026, 1, 12, 3)


def _synced(spark: SparkSession, sf_dir: str) -> str:
    store, embed = new_dir(spark, "vectors"), hashed_words()
    sync_embeddings(staged_games(spark, sf_dir, "F"), store, embed, _FIRST, buckets=16)
    sync_embeddings(staged_games(spark, sf_dir), store, embed, _SECOND, buckets=16)
    return store


@query(
    "embed_sync_pending",
    "WITH " + _staged_sql("early", "l_linestatus = 'F'") + ", " + _staged_sql("stg") + """,
    first_run AS (SELECT * FROM early WHERE has_genres AND trim(description_raw) <> ''),
    second_run AS (SELECT * FROM stg WHERE has_genres AND trim(description_raw) <> ''
      AND NOT EXISTS (SELECT 1 FROM first_run f WHERE f.game_id = stg.game_id))
    SELECT game_id, name, description_raw, released_date, rating, metacritic_score, TRUE AS has_embedding,
      DATE '2026-01-05' AS embedded_on FROM first_run
    UNION ALL SELECT game_id, name, description_raw, released_date, rating, metacritic_score, TRUE,
      DATE '2026-01-12' FROM second_run""",
)
def embed_sync_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: games embedded by the first keep what it stored, although newer loads came."""
    columns = ["game_id", "name", "description_raw", "released_date", "rating", "metacritic_score"]
    return read_keyed(spark, _synced(spark, sf_dir)).select(
        *columns,
        F.col("embedding").isNotNull().alias("has_embedding"),
        F.to_date("embedded_at").alias("embedded_on"),
    )


_SLOT = "CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 64 AS slot"
_STORED = f"game_id, name, description_raw, released_date, rating, metacritic_score, {_GENRES} AS genres"


@query(
    "search_games",
    "WITH " + _staged_sql("early", "l_linestatus = 'F'") + ", " + _staged_sql("stg") + rf""",
    first_run AS (SELECT {_STORED} FROM early WHERE has_genres AND trim(description_raw) <> ''),
    stored AS (SELECT * FROM first_run UNION ALL SELECT {_STORED} FROM stg WHERE has_genres AND trim(description_raw) <> ''
      AND NOT EXISTS (SELECT 1 FROM first_run f WHERE f.game_id = stg.game_id)),
    tokens AS (SELECT game_id, unnest(regexp_extract_all(
      lower(concat_ws(' | ', name, genres, substr(description_raw, 1, 2000))), '[\p{{L}}\p{{N}}]+')) AS token FROM stored),
    slots AS (SELECT game_id, {_SLOT}, CAST(count(*) AS DOUBLE) AS n FROM tokens GROUP BY ALL),
    vectors AS (SELECT game_id, slot, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY game_id)) AS FLOAT) AS DOUBLE) AS w FROM slots),
    query AS (SELECT slot, CAST(count(*) AS DOUBLE) AS c FROM (SELECT {_SLOT} FROM (VALUES ('small'), ('ring')) t(token)) GROUP BY 1),
    cosines AS (SELECT game_id, sum(w * coalesce(c, 0)) / sqrt(sum(w * w)) / (SELECT sqrt(sum(c * c)) FROM query) AS cosine
      FROM vectors LEFT JOIN query USING (slot) GROUP BY 1)
    SELECT game_id, name, released_date, rating, metacritic_score, left(description_raw, 300) AS description_preview,
      round(cosine, 6) AS similarity FROM cosines JOIN stored USING (game_id) ORDER BY round(1 - cosine, 10), game_id LIMIT 20""",
)
def search_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search by text over the synced table, with all columns of the answer."""
    store = read_keyed(spark, _synced(spark, sf_dir))
    hits = search(store, embed_query(spark, "small ring", hashed_words()), "20")
    return hits.withColumn("similarity", F.round("similarity", 6))


@query(
    "dq_summary",
    _TOP + """, results(model, "column", test, failures) AS (
      SELECT 'stg_games', 'game_id', 'not_null', count(*) - count(game_id) FROM stg
      UNION ALL SELECT 'stg_games', 'name', 'not_null', count(*) - count(name) FROM stg
      UNION ALL SELECT 'stg_games', 'released_date', 'not_null', count(*) - count(released_date) FROM stg
      UNION ALL SELECT 'stg_games', 'game_id', 'unique', count(game_id) - count(DISTINCT game_id) FROM stg
      UNION ALL SELECT 'mart_top_games', 'game_id', 'not_null', count(*) - count(game_id) FROM top
      UNION ALL SELECT 'mart_top_games', 'combined_score', 'not_null', count(*) - count(combined_score) FROM top
      UNION ALL SELECT 'mart_top_games', 'overall_rank', 'not_null', count(*) - count(overall_rank) FROM top
      UNION ALL SELECT 'mart_top_games', 'game_id', 'unique', count(game_id) - count(DISTINCT game_id) FROM top
      UNION ALL SELECT 'mart_top_games', 'overall_rank', 'unique', count(*) - count(DISTINCT overall_rank) FROM top)
    SELECT * FROM results""",
)
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = materialise(staged_games(spark, sf_dir), "staging")
    models = {"stg_games": games, "mart_top_games": marts.mart_top_games(games)}
    tests = {
        "stg_games": TESTS["stg_games"]._replace(not_null=["game_id", "name", "released_date"]),
        "mart_top_games": TESTS["mart_top_games"],
    }
    return quality.summary(models, tests)


def _bronze_of_latest(spark: SparkSession, sf_dir: str) -> str:
    """The latest record of each game, and the lookups, as bronze files of one date."""
    bronze, day = new_dir(spark, "bronze"), F.lit(dt.date(2026, 1, 5)).alias("ingest_date")
    # Line items are cut to the latest of each part first: documents are built, sorted and shuffled for those alone.
    lines = latest_by_key(table(spark, sf_dir, "lineitem"), ["l_partkey"], F.col("l_shipdate"), [F.desc(c) for c in _TIES])
    raw = game_documents(lines, table(spark, sf_dir, "part")).withColumn("_id", F.variant_get("raw_data", "$.id", "bigint"))
    latest = latest_by_key(raw, ["_id"], F.col("loaded_at"), [F.desc(c) for c in _TIES])
    write_bronze(latest.select("raw_data", day), bronze, "games")
    for entity in ("genres", "platforms"):
        write_bronze(_lookup(spark, sf_dir).select("raw_data", day), bronze, entity)
    return bronze


@query("run_all_marts", _TOP + " SELECT * FROM top")
def run_all_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, load to publish, stopped once between gate and publish and run again: what was loaded and
    staged before is neither loaded nor staged again."""
    bronze, out = _bronze_of_latest(spark, sf_dir), new_dir(spark, "run")

    def stopped(texts: list[str], input_type: str) -> list[list[float]]:
        raise RuntimeError("stopped before the vectors were stored")

    try:
        run_all(spark, bronze, out, stopped, _FIRST, buckets=8)
    except Exception as error:  # noqa: BLE001
        if "stopped before" not in str(error):
            raise
    again = run_all(spark, bronze, out, hashed_words(), _SECOND, buckets=8)
    if any(again["loaded"].values()) or not again["embedded"]:
        raise AssertionError(f"the second run began from the start: {again}")
    return read_published(spark, f"{out}/published", "mart_top_games")


@query(
    "preview_games",
    f"""SELECT l_partkey AS id, p_name AS name, CASE WHEN l_linenumber = 6 THEN 'TBA' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS released,
          CASE WHEN l_linenumber <> 5 THEN l_quantity / 10 END AS rating,
          CASE WHEN l_linenumber <> 7 THEN CAST(round(l_discount * 1000) AS INTEGER) END AS metacritic,
          CASE WHEN l_linenumber <> 2 THEN p_type || '/' || p_brand ELSE '' END AS genres, l_linestatus AS platforms
        FROM lineitem JOIN part ON l_partkey = p_partkey
        ORDER BY l_shipdate DESC NULLS LAST, {", ".join(c + " DESC" for c in _TIES)} LIMIT 20""",
)
def preview_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first records of the newest loads."""
    raw = raw_games(spark, sf_dir)
    newest = preview(raw.orderBy(F.desc("loaded_at"), *[F.desc(c) for c in _TIES]), 20)
    names = {c: F.array_join(F.coalesce(c, F.array().cast("array<string>")), "/") for c in ("genres", "platforms")}
    return newest.withColumns(names)


@query(
    "stamped_loads",
    """WITH n AS (SELECT count(DISTINCT l_partkey) AS documents FROM lineitem JOIN part ON l_partkey = p_partkey)
       SELECT load, documents, CAST(1 AS BIGINT) AS stamps, load <> 'replayed' AS recent
       FROM n, (SELECT unnest(['current', 'replayed', 'staged']) AS load)""",
)
def stamped_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load has one stamp, the current time or that of a replay, and a staging run one time of its own."""
    games = f"{_bronze_of_latest(spark, sf_dir)}/games"
    loads = {"current": read_raw(spark, games), "replayed": read_raw(spark, games, _FIRST)}
    stamps = [df.select(F.lit(name).alias("load"), F.col("loaded_at").alias("stamp")) for name, df in loads.items()]
    stamps.append(staging.stg_games(loads["replayed"]).select(F.lit("staged").alias("load"), F.col("dbt_loaded_at").alias("stamp")))
    rows = stamps[0].union(stamps[1]).union(stamps[2])
    recent = F.col("stamp").between(F.current_timestamp() - F.expr("INTERVAL 1 HOUR"), F.current_timestamp())
    return rows.groupBy("load").agg(
        F.count("*").alias("documents"), F.count_distinct("stamp").alias("stamps"), F.bool_and(recent).alias("recent")
    )


_RUNS = (dt.date(1997, 6, 30), dt.date(1997, 8, 31))


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """Pages of one order each, in two run folders, with the details of the larger parts in both."""
    landing = new_dir(spark, "landing")
    lines = table(spark, sf_dir, "lineitem").withColumn("line", F.col("l_linenumber"))
    day = F.when(F.col("line") == 6, "TBA").when(F.col("line") != 5, F.date_format("l_shipdate", "yyyy-MM-dd"))
    record = F.struct(F.col("l_partkey").alias("id"), day.alias("released"), F.col("l_quantity").alias("rating"), F.col("line").alias("suggestions_count"))
    parts = table(spark, sf_dir, "part").where("p_size > 10")
    details = parts.select(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("description_raw"), F.lit(None).cast("int").alias("rating")).alias("d"))
    lookups = _lookup(spark, sf_dir).select(F.to_json(F.struct(F.array("raw_data").alias("results"))).alias("value"))
    for at, run in enumerate(_RUNS):
        pages = lines.where(F.pmod("line", F.lit(2)) == at).groupBy("l_orderkey").agg(F.collect_list(record).alias("results"))
        pages.select(F.to_json(F.struct("results", F.lit(None).cast("string").alias("next"))).alias("value")).write.text(f"{landing}/games/{run}")
        details.select(F.to_json("d").alias("value")).write.text(f"{landing}/details/{run}")
        for entity in ("genres", "platforms"):
            lookups.write.text(f"{landing}/{entity}/{run}")
    return landing


@query(
    "ingest_games",
    """SELECT run AS ingest_date, l_partkey AS id, strftime(l_shipdate, '%Y-%m-%d') AS released, l_quantity AS rating,
         l_linenumber AS suggestions_count, CASE WHEN p_size > 10 THEN p_name END AS description
       FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN (SELECT 0 AS half, DATE '1997-06-30' AS run UNION ALL SELECT 1, DATE '1997-08-31')
         ON l_linenumber % 2 = half AND CAST(l_shipdate AS DATE) BETWEEN run - 59 AND run
       WHERE l_linenumber NOT IN (5, 6)""",
)
def ingest_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs from landed pages to bronze, the first of them twice: a run reads its own folder and replaces its own date."""
    landing, bronze = _landing(spark, sf_dir), new_dir(spark, "bronze")
    for run in (_RUNS[0], *_RUNS):
        ingest(spark, landing, bronze, as_of=run, days=60, run=run)
    got = read_raw(spark, f"{bronze}/games")
    value = lambda key, kind: F.variant_get("raw_data", f"$.{key}", kind)
    return got.select(
        "ingest_date", value("id", "bigint").alias("id"), value("released", "string").alias("released"), value("rating", "double").alias("rating"),
        value("suggestions_count", "int").alias("suggestions_count"), value("description_raw", "string").alias("description"),
    )
