"""A corpus pipeline: documents to shards of a training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and gives the documents that go on; it reads everything
the stage before kept. Rows that repeat an id are told apart by a hash of all their columns; rows
equal in every column are interchangeable, and stages that decide per group treat them as a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questlake.llm.common import WORD, free_name, record_hash
from questlake.llm.decontaminate import contamination
from questlake.llm.jaccard_join import near_duplicates
from questlake.llm.mixing import mix
from questlake.llm.quality import fit_quality, score_quality
from questlake.llm.sharding import read_shards, shuffle_to_files
from questlake.session import bound_batches, new_dir, share_code

SHARDS = 8
#: The stage's own rule of near copies, wider than that of op7's query: words a shingle, shared shingles in a hundred of both sets.
NEAR_SIZE, NEAR_PERCENT = 5, 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _decided(docs: DataFrame, tag: str, decisions: DataFrame, field: str) -> DataFrame:
    """One row of ``docs`` per id and tag in ``decisions``, with the decision ``field`` of it."""
    own = free_name(docs, "decision_id")
    found = decisions.select(F.col("doc_id").alias(own), F.col("tag").alias(f"{own}_tag"), F.col(field).alias(f"{own}_{field}"))
    on = docs["doc_id"].eqNullSafe(found[own]) & (docs[tag] == found[f"{own}_tag"])
    equal = Window.partitionBy("doc_id", tag).orderBy(F.lit(0))
    return docs.join(found, on).withColumn(f"{own}_n", F.row_number().over(equal)).where(F.col(f"{own}_n") == 1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of these documents."""
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    score = free_name(docs, "quality_score")
    return score_quality(docs, model, into=score).where(F.col(score) >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the least id. Rows without words
    are linked with nothing: all of them stay, also those that are equal in every column."""
    tag = free_name(docs, "record_hash")
    has_words = F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    tagged = docs.where(has_words).withColumn(tag, record_hash(docs))
    kept = near_duplicates(tagged, tag=tag, size=NEAR_SIZE, percent=NEAR_PERCENT).where("kept")
    return _decided(tagged, tag, kept, "kept").select(*docs.columns).union(docs.where(~has_words))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth occurs in the benchmark, unchanged."""
    found = contamination(docs, _table(spark, sf_dir, "benchmark"), records=True)
    return found.where("NOT contaminated").select("record.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    tag = free_name(docs, "record_hash")
    tagged = docs.withColumn(tag, record_hash(docs))
    copies = mix(tagged, tag=tag).groupBy("doc_id", "tag").agg(F.sum("copies").alias("copies")).where("copies > 0")
    own = free_name(docs, "decision_id")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{own}_copies"))).alias(f"{own}_copy")
    return _decided(tagged, tag, copies, "copies").select(*docs.columns, times).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order over equal shards, as ``shard`` and ``slot``."""
    path = new_dir(spark, "shards")
    shuffle_to_files(docs, path)
    return read_shards(spark, path, SHARDS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shared(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        share_code(spark)
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [(f.__name__, _shared(f)) for f in (quality, near_dedup, decontaminate, mixing, sharding)]

#: The classifier's model and the mix's rates are fitted, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written to the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
