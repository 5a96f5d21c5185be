import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from questlake.operators.cells import build_cells, refresh_cells, search_cells
from questlake.operators.embed import hashed_words, with_embedding
from questlake.operators.vector import clamp_limit, cosine_topk, cosine_topk_batch, local_topk, unit_rows
from questlake.plans.embed_sync import embed_query, search

DIMS = 8


@pytest.fixture(scope="module")
def vectors():
    """A third are copies of one vector; one is zero and one is missing."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(600, DIMS)).astype(np.float32)
    rows[rng.permutation(600)[:200]] = rows[0]
    rows[17] = 0
    return rows


@pytest.fixture(scope="module")
def table(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(9999, None)]
    return spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)


def brute(vectors, query, k):
    rows, q = vectors.astype(np.float64), np.asarray(query, dtype=np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        distance = 1 - rows @ q / np.linalg.norm(rows, axis=1) / np.linalg.norm(q)
    keyed = [(math.inf if math.isnan(d) else round(float(d), 10), i) for i, d in enumerate(distance)]
    return [i for _, i in sorted(keyed)[:k]]


def test_limit():
    assert [clamp_limit(x) for x in (None, "x", "5", 5, "99", "1.5", 0)] == [10, 10, 5, 5, 20, 10, 0]
    with pytest.raises(ValueError):
        clamp_limit(-1)


def test_topk(table, vectors):
    for n in (0, 5, 42):
        got = cosine_topk(table, vectors[n].tolist(), 10, "id").orderBy("distance", "id").collect()
        assert [r.id for r in got] == brute(vectors, vectors[n], 10)
    everything = cosine_topk(table, vectors[5].tolist(), 700, "id").orderBy("distance", "id").collect()
    assert len(everything) == 600
    assert everything[-1].id == 17
    assert math.isnan(everything[-1].distance)


def test_one_dimension_per_table(table):
    with pytest.raises(Exception, match="8|elements"):
        cosine_topk(table, [1.0, 0.0], 3, "id").collect()


@pytest.mark.parametrize("query_bytes", [64 << 20, 40 * DIMS * 8])
def test_batch_broadcast_and_blocked(spark, table, vectors, query_bytes):
    """The second size makes 15 query blocks."""
    queries = table.select(F.col("id").alias("q"), F.col("embedding").alias("query_embedding"))
    got = cosine_topk_batch(table, queries, 5, "id", "q", query_bytes=query_bytes, chunk_rows=100)
    found = {}
    for r in got.orderBy("q", "rank").collect():
        found.setdefault(r.q, []).append(r.id)
    assert len(found) == 600
    for q in set(range(600)) - {17}:
        assert found[q] == brute(vectors, vectors[q], 5), q


def test_batch_of_no_queries(table):
    queries = table.where("false").select(F.col("id").alias("q"), F.col("embedding").alias("query_embedding"))
    assert cosine_topk_batch(table, queries, 5, "id", "q").count() == 0


def test_cells_are_exact_unless_approximate(spark, table, vectors, tmp_path):
    path = str(tmp_path / "index")
    build_cells(table, path, "id", cells=12)
    assert spark.read.parquet(f"{path}/vectors").count() == 600
    for n in (0, 5, 42, 99):
        got = search_cells(spark, path, vectors[n].tolist(), 10, "id", probes=1).orderBy("distance", "id").collect()
        assert [r.id for r in got] == brute(vectors, vectors[n], 10)
    whole = search_cells(spark, path, vectors[5].tolist(), 700, "id", probes=1)
    assert whole.count() == 600
    near = {r.id for r in search_cells(spark, path, vectors[5].tolist(), 10, "id", probes=3, approximate=True).collect()}
    assert 5 in near


@pytest.mark.parametrize("distinct", [1, 2, 3])
def test_more_cells_than_distinct_vectors(spark, distinct, tmp_path):
    rows = [(i, [1.0, float(i % distinct)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    build_cells(df, str(tmp_path / "i"), "id", cells=8)
    got = search_cells(spark, str(tmp_path / "i"), [1.0, 0.0], 4, "id").orderBy("distance", "id").collect()
    assert [r.id for r in got] == [0, distinct, 2 * distinct, 3 * distinct]


def test_refresh_adds_new_vectors_once(spark, table, vectors, tmp_path):
    path = str(tmp_path / "index")
    build_cells(table.where("id < 100"), path, "id", cells=5)
    for _ in range(2):
        refresh_cells(table, path, "id")
        assert spark.read.parquet(f"{path}/vectors").count() == 600
    for n in (0, 5, 599):
        got = search_cells(spark, path, vectors[n].tolist(), 10, "id", probes=1).orderBy("distance", "id").collect()
        assert [r.id for r in got] == brute(vectors, vectors[n], 10)


def test_embedding_batches_and_nulls(spark):
    def model(texts, input_type):
        assert len(texts) <= 20 and input_type == "document"
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.range(55).select("id", F.when(F.col("id") != 7, F.repeat(F.lit("a"), F.col("id").cast("int"))).alias("t"))
    got = {r.id: r.embedding for r in with_embedding(df.coalesce(1), F.col("t"), model).collect()}
    assert got[7] is None
    assert all(got[i] == [float(i), 1.0] for i in range(55) if i != 7)


def test_default_model():
    embed = hashed_words(32)
    one, two, empty = embed(["Red fox, red Fox", "blue sea", "..."], "document")
    assert np.isclose(np.linalg.norm(one), 1) and not np.any(empty)
    assert np.allclose(one, embed(["red FOX red fox"], "document")[0])
    assert not np.allclose(one, two)


def test_default_model_in_spark_gives_the_same_vectors(spark):
    model = hashed_words(48)
    texts = ["Red fox, red_Fox 12", "", "...", None, "Ärger über ÄRGER 東京 x" * 50, "a " * 5000]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for kind in ("document", "query"):
        table = with_embedding(rows, F.col("t"), model, input_type=kind)
        assert "Python" not in table._jdf.queryExecution().toString()
        got = {r.id: r.embedding for r in table.collect()}
        assert got[3] is None
        for i, text in enumerate(texts):
            if text is not None:
                assert got[i] == model([text], kind)[0].astype(np.float32).tolist()


def test_search(spark):
    texts = ["deep space war", "quiet farm life", "space trade"]
    rows = spark.createDataFrame([(i, t, t + "x" * 400) for i, t in enumerate(texts)], "game_id long, name string, description_raw string")
    rows = rows.withColumns({"released_date": F.current_date(), "rating": F.lit(1.0), "metacritic_score": F.lit(1)})
    embed = hashed_words(256)
    table = with_embedding(rows, F.col("name"), embed)
    got = search(table, embed_query(spark, " farm life ", embed), "2").collect()
    assert got[0].game_id == 1 and len(got) == 2
    assert len(got[0].description_preview) == 300
    assert got[0].similarity > got[1].similarity
    with pytest.raises(ValueError):
        embed_query(spark, "  ", embed)


def test_many_queries_are_met_in_slices():
    queries, rows = (unit_rows(np.random.default_rng(seed).normal(size=(n, 8))) for seed, n in ((1, 20_000), (2, 300)))
    keys = np.random.default_rng(3).permutation(300)
    batch = pa.record_batch([pa.array(keys), pa.array(list(rows))], ["key", "vector"])
    tracemalloc.start()
    index, found, distance = local_topk(3, 8)(queries, [batch])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # all queries at once held 130 MB
    exact = np.round(1 - queries @ rows.T, 10)
    order = np.lexsort((np.broadcast_to(keys, exact.shape), exact), axis=1)[:, :3]
    assert (index == np.repeat(np.arange(20_000), 3)).all()
    assert (found == keys[order].ravel()).all()
    assert np.allclose(distance, np.take_along_axis(exact, order, axis=1).ravel(), atol=1e-9)
