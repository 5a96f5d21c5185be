"""Sharding by an external shuffle in two passes.

The first pass scatters the records evenly into buckets that fit into memory, by seeded hashes.
The second reads one bucket at a time, puts it into random order by a Fisher-Yates shuffle and
writes it. The buckets one after the other are the whole table in random order; shard ``k`` is
the ``k``-th of equal slices of it, so the shards' row counts differ by at most one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEED = 41
BUCKET_BYTES = 32 << 20
#: More buckets are never made: what is broadcast to readers is one small row per bucket.
MOST_BUCKETS = 1 << 20
#: Rows that leave a bucket at a time.
_OUT = 500
_OWN = ("shard_bucket", "shard_order", "shard_place", "shard", "slot")


def _mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key (the finaliser of splitmix64)."""
    keys = keys + np.uint64(0x9E3779B97F4A7C15)
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def _scatter(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chooses each row's bucket and place from its key, and from how often the task has seen that
    key: rows that repeat an id, or have none, are spread like all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            keys = batch.column("shard_order").to_numpy().view(np.uint64)
            times = np.zeros(len(keys), np.uint64)
            for at, key in enumerate(keys.tolist()):
                times[at] = seen[key]
                seen[key] += 1
            order = _mixed(keys ^ _mixed(times))
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["shard_bucket"] = pa.array((_mixed(order) % np.uint64(buckets)).astype(np.int32))
            columns["shard_order"] = pa.array(order.view(np.int64))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _shuffled(rows: list[pa.RecordBatch], bucket: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The rows in random order. ``rows`` is emptied, so that one copy of the bucket is held."""
    table = pa.Table.from_batches(rows).combine_chunks()
    rows.clear()
    place = np.arange(table.num_rows)
    np.random.default_rng([seed, bucket]).shuffle(place)  # Fisher-Yates
    at = table.schema.get_field_index("shard_place")
    for start in range(0, len(place), _OUT):
        part = table.take(pa.array(place[start : start + _OUT]))
        part = part.set_column(at, "shard_place", pa.array(np.arange(start, start + part.num_rows), pa.int64()))
        yield from part.combine_chunks().to_batches()


def _shuffle_buckets(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        bucket = None
        for batch in batches:
            buckets = batch.column("shard_bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1).tolist(), len(buckets)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                if held and buckets[start] != bucket:
                    yield from _shuffled(held, bucket, seed)
                    held = []
                bucket = int(buckets[start])
                held.append(batch.slice(start, end - start))
        if held:
            yield from _shuffled(held, bucket, seed)

    return run


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower() in _OWN])


def shuffle_to_files(
    docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> None:
    """Write all rows and columns of ``docs`` in random order to ``path``, for ``read_shards``.

    A column of ``docs`` named like one of this module's own (``shard``, ``slot``, ``shard_*``) is
    dropped. NULL ids and texts, empty texts and repeated rows are rows like any other. A row is
    never split, so a task holds one bucket, or one row if that is larger.
    """
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 1
    total = docs.agg(F.sum(size.cast("long"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(1, -(-total // bucket_bytes)))
    rows = _plain(docs).withColumns(
        {
            "shard_bucket": F.lit(0),
            "shard_order": F.xxhash64(F.lit(seed), F.col(doc_id)),
            "shard_place": F.lit(0).cast("long"),
        }
    )
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    scattered = rows.mapInArrow(_scatter(buckets), schema)
    placed = scattered.repartition(buckets, "shard_bucket").sortWithinPartitions("shard_bucket", "shard_order")
    placed.mapInArrow(_shuffle_buckets(seed), schema).drop("shard_order").write.parquet(path)


def read_shards(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """The rows at ``path`` with ``shard`` (from 0) and ``slot`` (the row's place in its shard)."""
    rows = spark.read.parquet(path)
    counts = rows.groupBy("shard_bucket").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("shard_bucket")
    starts = counts.select(
        "shard_bucket",
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n_all"),
    )
    place = F.col("start") + F.col("shard_place")
    least = F.floor(F.col("n_all") / shards)
    larger = F.pmod(F.col("n_all"), F.lit(shards))
    edge = larger * (least + 1)
    at, rest = place, place - edge
    shard = F.when(at < edge, F.floor(at / (least + 1))).otherwise(larger + F.floor(rest / F.greatest(least, F.lit(1))))
    slot = F.when(at < edge, F.pmod(at, least + 1)).otherwise(F.pmod(rest, F.greatest(least, F.lit(1))))
    found = rows.join(F.broadcast(starts), "shard_bucket").withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")})
    return found.select(*[c for c in rows.columns if c not in _OWN], "shard", "slot")
