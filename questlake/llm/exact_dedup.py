"""Exact duplicates: a tree merge of sorted digest runs.

Each input partition is reduced to a run: its digests in order, each with the smallest identifier
and the number of rows. Nodes of a binomial tree then exchange runs in rounds. In round r, the two
nodes whose numbers differ in bit r alone swap rows, so that each keeps the digests whose bucket has
its own bit there, and merges the runs it gets. After the last round each node holds the whole group
of every digest of its bucket. A digest that is very frequent enters a merge at most twice, whatever
the number of its copies. A larger ``fan_in`` has more nodes swap at once, in fewer rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import SPACES, lookup, shuffle_partitions, written

_RUN = "node long, digest binary, check_hash long, n_bytes long, keep_null boolean, keep_id {kind}, keep_row long, copies long"
#: Digest and what verifies it: texts are one group only if a second hash and the length agree too.
_KEY = ["digest", "check_hash", "n_bytes"]
_ORDER = [*_KEY, "keep_null", "keep_id", "keep_row"]


def _merge_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per group from rows in order of group and identifier: the first, with all copies counted."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        starts = np.zeros(batch.num_rows, bool)
        starts[0] = True
        for name in ["node", *_KEY]:
            column = batch.column(name)
            starts[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(starts)
        copies = np.add.reduceat(batch.column("copies").to_numpy(), first)
        columns = {n: c.take(pa.array(first)) for n, c in zip(batch.schema.names, batch.columns, strict=True)}
        columns["copies"] = pa.array(copies, pa.int64())
        merged = pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)
        yield merged[:-1]
        held = merged[-1:]
    if held is not None:
        yield held


def tree(nodes: int, fan_in: int) -> tuple[int, int]:
    """(fan, rounds) of a tree over at least ``nodes`` leaves whose fan is at most ``fan_in``."""
    rounds = 1
    while fan_in**rounds < nodes:
        rounds += 1
    fan = 2
    while fan**rounds < nodes:
        fan += 1
    return fan, rounds


def exact_dedup(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", nodes: int | None = None, fan_in: int = 2) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``keep_id`` (the id that stays of its group), ``group_size``,
    ``kept`` and ``text_sha256``, over texts whose runs of spaces are one space each.

    NULL texts equal empty ones. NULL ids come last: they stay only if a group has no other. Of
    rows that repeat the kept id, one is kept. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    fan, rounds = tree(nodes or shuffle_partitions(spark), fan_in)
    leaves = fan**rounds
    plain = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), SPACES, " ")
    digests = docs.select(F.col(doc_id).alias("doc_id"), plain.alias("plain")).select(
        "doc_id",
        F.unhex(F.sha2("plain", 256)).alias("digest"),
        F.xxhash64("plain").alias("check_hash"),
        F.octet_length("plain").cast("long").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    digests = written(digests, "digests")

    runs = digests.select(
        F.pmod(F.shiftright("row", 33), F.lit(leaves)).alias("node"),
        *_KEY,
        F.col("doc_id").isNull().alias("keep_null"),
        F.col("doc_id").alias("keep_id"),
        F.col("row").alias("keep_row"),
        F.lit(1).cast("long").alias("copies"),
    )
    schema = _RUN.format(kind=dict(digests.dtypes)["doc_id"])
    runs = runs.sortWithinPartitions("node", *_ORDER).mapInArrow(_merge_runs, schema)
    bucket = F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(leaves))
    for level in range(rounds):
        step = fan**level
        own = F.pmod(F.floor(F.col("node") / step), F.lit(fan))
        wanted = F.pmod(F.floor(bucket / step), F.lit(fan))
        runs = runs.withColumn("node", (F.col("node") + (wanted - own) * step).cast("long"))
        runs = runs.repartitionById(leaves, F.col("node").cast("int")).sortWithinPartitions("node", *_ORDER).mapInArrow(_merge_runs, schema)
    groups = written(runs.where("copies > 1").withColumn("key", F.struct(*_KEY)), "groups")

    total = F.broadcast(digests.agg(F.count(F.lit(1)).alias("n_all")))
    hot = groups.join(total, F.col("copies") * 1000 > F.col("n_all"))
    rows = digests.withColumn("key", F.struct(*_KEY))
    found = lookup(rows, groups, "key", hot, ["keep_id", "keep_row", "copies"])
    alone = F.col("copies").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
