"""Importance resampling towards a target distribution.

A text's features are its words and word pairs, hashed into a fixed number of buckets. The buckets of
all documents and of all target texts are counted; the log ratio of the two shares is a bucket's gain,
and a document's weight is the mean gain of its features, read from one array. With a Gumbel number of
a seeded hash added, the documents of highest score are a draw without replacement by weight.

Ranks come from a parallel sort by regular sampling: every task leaves a sorted run, regular samples of
the runs give splitters, the runs are cut at them, the segments that a draw can reach are exchanged and
merged, and counts of the segments before turn places into exact ranks.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlake.llm.common import plain_words, texts_of, written

BUCKETS = 10_000
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: Rows that a segment of the sort is planned for, and the most samples that are sorted in one task. Results do not depend on them.
SEGMENT_ROWS, MOST_SAMPLES = 200_000, 1 << 20
# monotonically_increasing_id: the task above the lowest 33 bits, the row's place in it below.
_ROW_BITS = 33


def feature_buckets(text: bytes | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of each word and each pair of neighbours: the CRC of its UTF-8 bytes.
    The CRC of a pair goes on from that of its first word."""
    words = plain_words(text or b"")
    ones = list(map(crc32, words))
    pairs = list(map(crc32, [b" " + w for w in words[1:]], ones))
    return len(words), np.array(ones + pairs, np.uint32) % np.uint32(buckets)


def _count(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                counts += np.bincount(feature_buckets(text, buckets)[1], minlength=buckets) if text else 0
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some.astype(np.int32)), "n": pa.array(counts[some])})

    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row per bucket at most, and the driver gets one."""
    found = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(_count(buckets), "bucket int, n long")
    counts = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket ``floor(1000 * ln(...))`` of its smoothed share in the target over that in the source."""
    all_source, all_target, buckets = int(source.sum()), int(target.sum()), len(source)
    ratio = (target + 1.0) * float(all_source + buckets) / ((source + 1.0) * float(all_target + buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio.tolist()], np.int64)


def luck(doc_id: object, seed: int = SEED) -> int:
    """The Gumbel number of an id, in thousandths; a NULL id is an empty one."""
    named = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gain: np.ndarray, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weights, scores = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text")), strict=True):
                n, found = feature_buckets(text, len(gain))
                weight = int(gain[found].sum()) // len(found) if len(found) else 0
                words.append(n)
                features.append(len(found))
                weights.append(weight)
                scores.append(weight + luck(doc_id, seed))
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            columns |= {"n_words": words, "n_features": features, "weight": weights, "score": scores}
            arrays = {n: v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for n, v in columns.items()}
            yield pa.RecordBatch.from_pydict(arrays)

    return run


def importance(docs: DataFrame, gain: np.ndarray, *, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of each row; a text without words has weight 0."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {rows.dtypes[0][1]}, n_words long, n_features long, weight long, score long"
    return rows.mapInArrow(_score(gain, seed), schema)


_ORDER = ("score", "doc_id", "n_features", "place")


def _key(score: int, doc_id: object, n_features: int, place: int) -> tuple:
    """Sorts like ``_sorted``: by score downwards, then by id with NULL last. ``place`` is the row's own, so
    no two keys are equal and rows equal in all else can be in different segments."""
    return (-score, doc_id is None, 0 if doc_id is None else doc_id, n_features, place)


def _sorted() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]


def _cut(splitters: list[tuple]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The segment of each row: how many splitters come before it or are it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in _ORDER), strict=True)
            segment = pa.array([bisect_right(splitters, _key(*row)) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, segment], [*batch.schema.names, "segment"])

    return run


def regular_splitters(runs: DataFrame, rows: int, segment_rows: int = SEGMENT_ROWS, most_samples: int = MOST_SAMPLES) -> list[tuple]:
    """Keys that cut all runs into segments of about ``segment_rows`` rows.

    ``runs`` holds ``rows`` rows, each with its run and place in ``place``. Every run gives the rows at regular
    distances, and regular places of all samples in order are the splitters. The distance is one for all runs, so
    a sample stands for as many rows in each, and no splitter is off by more than a distance per run. The samples,
    at most ``most_samples`` and the runs' number, are sorted in one task; only the splitters come to the driver.
    """
    segments = -(-rows // segment_rows)
    if segments < 2:
        return []
    number = runs.agg(F.count_distinct(F.shiftright("place", _ROW_BITS))).first()[0]
    # As many samples a run as there are segments, as long as one task can sort them.
    distance = max(1, -(-rows // most_samples), rows // (segments * max(1, number)))
    at = F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    samples = runs.where(F.pmod(at, F.lit(distance)) == distance // 2).select(*_ORDER)
    order = Window.orderBy(*_sorted(), "place")
    placed = samples.withColumn("nth", F.row_number().over(order)).withColumn("n_samples", F.count(F.lit(1)).over(Window.partitionBy()))
    step = F.greatest(F.lit(1), F.ceil(F.col("n_samples") / segments))
    return [_key(*row) for row in placed.where(F.pmod("nth", step) == 0).orderBy("nth").select(*_ORDER).collect()]


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_features, weight, score`` and ``rank`` (from 1, NULL for rows not drawn).

    Drawn are ``floor(percent * N / 100)`` of the ``N`` rows with at least ``least_words`` words: those of highest
    score, of equal ones that of the smaller id, NULL ids last, then that of fewer features; rows equal in all of
    that are interchangeable. NULL texts have no words. Other columns are not read. An empty ``target`` gives every
    bucket the same share in it. Weights and scores are of whole numbers, so a rerun gives the same draw.
    """
    gain = gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    scored = importance(docs, gain, doc_id=doc_id, text=text, seed=seed).withColumn("able", F.col("n_words") >= least_words)
    # Able rows come first in a run, so that places count them alone.
    in_order = scored.sortWithinPartitions(F.col("able").desc(), *_sorted())
    scored = written(in_order.withColumn("place", F.monotonically_increasing_id()), "runs")
    runs = scored.where("able").drop("able")
    rows = runs.count()
    drawn = percent * rows // 100
    splitters = regular_splitters(runs, rows, segment_rows)
    schema = ", ".join(f"{n} {t}" for n, t in runs.dtypes) + ", segment int"
    cut = written(runs.mapInArrow(_cut(splitters), schema), "segments")
    counts, before, reached = dict(cut.groupBy("segment").count().collect()), [0], 0
    for segment in range(len(splitters) + 1):
        reached = segment + 1 if before[-1] < drawn else reached
        before.append(before[-1] + counts.get(segment, 0))
    # Only what a draw can reach is exchanged; a segment is a partition and Spark's sort merges its runs.
    merged = cut.where(F.col("segment") < reached).repartitionById(max(1, reached), "segment")
    merged = merged.sortWithinPartitions("segment", *_sorted(), "place").withColumn("at", F.monotonically_increasing_id())
    merged = written(merged, "merged")
    starts = docs.sparkSession.createDataFrame(list(enumerate(before[:-1])), "segment int, start long")
    rank = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    ranked = merged.join(F.broadcast(starts), "segment").select("doc_id", "n_words", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))
    left = cut.where(F.col("segment") >= reached).unionByName(scored.where(~F.col("able")), allowMissingColumns=True)
    return ranked.unionByName(left.select("doc_id", "n_words", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
