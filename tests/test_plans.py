"""The physical plans that the scale of the library rests on."""

import re

import pytest
from pyspark.sql import functions as F

from questlake.operators import quality
from questlake.operators.rank import rank_rows
from questlake.operators.vector import cosine_topk, with_details
from questlake.plans import marts, staging
from questlake.session import materialise
from questlake.sources.snapshots import merge_buckets


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, docs):
    document = '{"id": 1, "name": "n", "released": "2026-01-01", "rating": 4.5, "metacritic": 80, "genres": [{"name": "A"}]}'
    return materialise(docs(document), "raw")


def test_staging_reads_the_extracted_paths_only(raw):
    """The statistics need id, rating, metacritic and description: four typed values (and the
    id as a variant, to tell a JSON null from a missing key)."""
    text = plan(marts.mart_catalog_stats(staging.stg_games(raw, strict=False)))
    types = re.search(r"ReadSchema: struct<raw_data:struct<([^>]*)>", text).group(1)
    assert sorted(part.split(":")[1].split("(")[0] for part in re.findall(r"\d+:[a-z]+", types)) == sorted(
        ["decimal", "double", "decimal", "string", "variant"]
    )


def test_marts_prune_columns_of_stored_staging(raw):
    games = materialise(staging.stg_games(raw), "games")
    schema = re.search(r"ReadSchema: (\S+)", plan(marts.mart_daily_release_counts(games))).group(1)
    assert schema == "struct<game_id:bigint,released_date:date,rating:double,metacritic_score:int>"
    assert "PushedFilters: [IsNotNull(released_date)]" in plan(marts.mart_daily_release_counts(games))


def test_trends_and_days_shuffle_partial_results(raw):
    games = materialise(staging.stg_games(raw), "games")
    for build in (marts.mart_genre_trends, marts.mart_daily_release_counts):
        text = plan(build(games))
        assert "partial_count" in text and "Expand" not in text and "distinct" not in text


def test_rank_gathers_counts_only(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    ranked = rank_rows(df, [F.desc("id")], overall="n", within={"m": ["g"]})
    for block in plan(ranked).split("Exchange SinglePartition")[1:]:
        assert "HashAggregate" in block.splitlines()[1]


def test_gate_scans_each_model_once(spark):
    models = {m: materialise(spark.range(100).select("id", (F.col("id") % 7).alias("g"), F.lit("wide").alias("text")), m) for m in ("a", "b")}
    text = plan(quality.summary(models, {m: quality.Tests(unique=["id", "g"], not_null=["id", "g", "text"]) for m in models}))
    assert text.split("Initial Plan")[0].count("FileScan parquet") == 2


def test_ranks_shuffle_full_rows_once(spark):
    """The one shuffle is that by range, before the rows are written: what is planned on the written rows
    shuffles counts alone."""
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"), F.lit("wide").alias("text"))
    for kinds in ({"overall": "n", "within": {"m": ["g"]}}, {"within": {"m": ["g"]}}):
        text = plan(rank_rows(df, [F.desc("id")], **kinds))
        for block in re.split(r"(?<!Broadcast)Exchange ", text)[1:]:
            assert "HashAggregate" in block.splitlines()[1]
        assert "SortMergeJoin" not in text


def test_topk_takes_ordered_and_looks_details_up(spark):
    table = materialise(spark.range(50).select("id", F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("embedding"), F.lit("t").alias("text")), "vectors")
    hits = cosine_topk(table, [1.0, 0.0], 3, "id")
    assert "TakeOrderedAndProject" in plan(hits)
    assert "text" not in re.search(r"ReadSchema: (\S+)", plan(hits)).group(1)
    details = plan(with_details(hits, table, "id"))
    assert "In(id, [" in details
    with pytest.raises(ValueError, match="more than 20"):
        with_details(cosine_topk(table, [1.0, 0.0], 30, "id"), table, "id")


def test_bucketed_table_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_buckets(spark.range(100).withColumn("v", F.lit(1)), path, "id", ["v"], buckets=4)
    text = plan(spark.read.parquet(path).where(F.col("bucket").isin([1])))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", text)
