"""What one Python worker holds at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from questlake.llm import jaccard_join, sharding, substring_dedup
from questlake.llm.shingles import words_of
from questlake.session import BATCH_BYTES, BATCH_SETTING, bound_batches


class _Value:
    def __init__(self, value):
        self.value = value


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _texts(rows: int) -> list[str]:
    return [" ".join(f"w{(i * 31 + j) % 5003}" for j in range(300)) for i in range(rows)]


def test_words_are_told_apart_in_small_pieces():
    column = pa.array(_texts(3000))
    assert _peak(lambda: sum(len(w.hashes) for w in words_of(column))) < 64 << 20


def test_words_of_whole_documents_are_not_held_for_a_batch():
    texts = _texts(2000)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    found = []
    peak = _peak(lambda: found.extend(substring_dedup._whole(_Value(bytes(1 << 17)))(iter([batch]))))
    assert found[0].column("kept_text").to_pylist() == texts
    assert found[0].column("n_words").to_pylist() == [300] * len(texts)
    assert peak < 4 * sum(map(len, texts))


@pytest.fixture
def unset(spark):
    spark.conf.unset(BATCH_SETTING)
    yield spark
    spark.conf.unset(BATCH_SETTING)


def test_stages_of_the_pipeline_get_small_batches(unset):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([batch.nbytes], pa.int64()), "n": pa.array([batch.num_rows], pa.int64())})

    rows = unset.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    stage = corpus_pipeline._shared(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "bytes long, n long"))
    found = stage(unset, rows, "").collect()
    assert sum(r["n"] for r in found) == 9000
    assert max(r["bytes"] for r in found) < 2 * BATCH_BYTES


def test_a_bound_of_the_session_stays(unset):
    unset.conf.set(BATCH_SETTING, "1m")
    bound_batches(unset)
    assert unset.conf.get(BATCH_SETTING) == "1m"


def test_a_bucket_is_shuffled_without_a_second_copy():
    n = 16_000
    whole = pa.RecordBatch.from_pydict({"id": pa.array(range(n)), "text": pa.array(["x" * 1000] * n), "shard_place": pa.array([0] * n)})
    before = pa.total_allocated_bytes()
    rows = [pa.Table.from_batches([whole.slice(k, 2000)]).take(pa.array(range(2000))).combine_chunks().to_batches()[0] for k in range(0, n, 2000)]
    bucket, out, most = sum(r.nbytes for r in rows), [], 0
    for batch in sharding._shuffled(rows, 3, 41):
        most = max(most, pa.total_allocated_bytes() - before)
        out.append((batch.column("id").to_pylist(), batch.column("shard_place").to_pylist()))
        del batch
    order = np.arange(n)
    np.random.default_rng([41, 3]).shuffle(order)
    assert sum((ids for ids, _ in out), []) == order.tolist()
    assert sum((places for _, places in out), []) == list(range(n))
    assert most < 1.5 * bucket


def test_counting_signatures_holds_few_copies_of_a_chunk():
    texts = [" ".join(f"w{i * 977 + j}" for j in range(2000)) for i in range(600)]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[k : k + 20])}) for k in range(0, len(texts), 20)]
    found = []
    peak = _peak(lambda: found.extend(jaccard_join._count(3, 90)(iter(batches))))
    got = pa.Table.from_batches(found)
    assert got.num_rows > 0 and set(got.column("times").to_pylist()) >= {1, 2}
    assert peak < 8 * 6 * jaccard_join._CHUNK
