"""A cell index for cosine search: fewer vectors are read, by default with the exact result.

Vectors are put into the cell of their nearest centre and written partitioned by cell, each
cell with its radius. A search scans the cells nearest to the query; with the distance of the
k-th hit in hand, the triangle inequality then tells which other cells can hold a nearer
vector, and only those are scanned too. ``approximate=True`` skips that second step.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from questlake.functions.bound import bound
from questlake.operators.merge import pending_rows
from questlake.operators.vector import cosine_topk, unit_rows
from questlake.session import materialise
from questlake.sources.snapshots import publish, read_published

CENTRE_BYTES = 256 << 20
ROWS_PER_CELL = 256
_SLACK = 1e-9
_ROUNDING = 1e-10  # of distances, which are rounded to ten digits


def _unit(vector: str) -> Column:
    value = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(value, F.lit(0.0), lambda total, x: total + x * x))
    return bound(norm, lambda n: F.when(n > 0, F.transform(value, lambda x: x / n)))


def _place(present: DataFrame, key: str, vector: str, centres: np.ndarray) -> DataFrame:
    """``(key, vector, cell, gap)``: the nearest centre of each vector and how far it is."""
    shared = present.sparkSession.sparkContext.broadcast(centres)

    def assign(batches):
        middle = shared.value
        squares, dims = (middle * middle).sum(axis=1), middle.shape[1]
        step = max(1, 4_000_000 // len(middle))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                flat = part.column(1).flatten()
                if len(flat) != part.num_rows * dims:
                    raise ValueError(f"vectors must all have {dims} elements")
                rows = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
                norms = np.sqrt((rows * rows).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    unit = rows / norms[:, None]
                nearest = np.argmin(squares - 2.0 * (np.nan_to_num(unit) @ middle.T), axis=1)
                gap = np.sqrt(((unit - middle[nearest]) ** 2).sum(axis=1))
                # A zero vector has no direction: its own cell, at no distance to prune by.
                cell = np.where(norms > 0, nearest, -1).astype(np.int32)
                columns = [part.column(0), part.column(1), pa.array(cell), pa.array(gap)]
                yield pa.RecordBatch.from_arrays(columns, [key, vector, "cell", "gap"])

    fields = [present.schema[key], present.schema[vector]]
    fields += [T.StructField("cell", T.IntegerType()), T.StructField("gap", T.DoubleType())]
    return present.mapInArrow(assign, T.StructType(fields))


def _write_cell_table(spark: SparkSession, path: str, centres: np.ndarray) -> None:
    """One row per centre, and one for the cell of zero vectors if there are any."""
    written = spark.read.parquet(f"{path}/vectors")
    stats = written.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius"))
    rows = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    publish(stats.join(rows, "cell", "full"), path, "cells", ["cell", "n", "radius", "centre"])


def _write_vectors(placed: DataFrame, path: str, mode: str) -> None:
    # Rebalancing gathers a cell into few files and splits a cell too large for one task.
    placed.hint("rebalance", "cell").write.mode(mode).partitionBy("cell").parquet(f"{path}/vectors")


def build_cells(
    vectors: DataFrame, path: str, key: str, vector: str = "embedding", cells: int | None = None, seed: int = 7
) -> None:
    """Write the index of ``vectors`` to ``path``.

    Centres are fitted by k-means, on a stored sample if there are more than 256 vectors per
    cell; every vector is then assigned and written. The centres are the only thing held on the
    driver and broadcast; their size is limited.
    """
    present = vectors.select(key, vector).where(F.col(vector).isNotNull())
    size = present.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("dims")).first()
    if not size.n:
        raise ValueError("no vectors to index")
    cells = max(2, cells or min(isqrt(size.n), CENTRE_BYTES // (8 * size.dims)))
    if cells * size.dims * 8 > CENTRE_BYTES:
        raise ValueError(f"{cells} centres of {size.dims} elements exceed {CENTRE_BYTES} bytes")

    fraction = min(1.0, ROWS_PER_CELL * cells / size.n)
    chosen = present if fraction == 1.0 else present.sample(fraction, seed)
    units = chosen.select(_unit(vector).alias("unit")).where(F.col("unit").isNotNull())
    train = materialise(units, "training")
    some = train.distinct().limit(2).collect()
    if not some:
        raise ValueError("all vectors are zero")
    if len(some) == 1:
        centres = np.array([some[0].unit])
    else:
        features = train.select(array_to_vector("unit").alias("features"))
        centres = np.array(KMeans(k=cells, seed=seed, maxIter=10).fit(features).clusterCenters())
    _write_vectors(_place(present, key, vector, centres), path, "overwrite")
    _write_cell_table(vectors.sparkSession, path, centres)


def _cells(spark: SparkSession, path: str) -> list[Row]:
    return read_published(spark, path, "cells").collect()


def refresh_cells(vectors: DataFrame, path: str, key: str, vector: str = "embedding") -> None:
    """Add the vectors whose key the index does not hold yet; the centres stay as they are.

    Finds them by an anti-join on the key, so a run that failed halfway can be repeated.
    """
    spark = vectors.sparkSession
    centres = np.array([r.centre for r in sorted(_cells(spark, path)) if r.centre is not None])
    present = vectors.select(key, vector).where(F.col(vector).isNotNull())
    new = pending_rows(present, spark.read.parquet(f"{path}/vectors").select(key), key)
    # Stored first: the index is not appended to while it is read.
    _write_vectors(materialise(_place(new, key, vector, centres), "cells"), path, "append")
    _write_cell_table(spark, path, centres)


def search_cells(
    spark: SparkSession,
    path: str,
    query: Sequence[float],
    k: int,
    key: str,
    vector: str = "embedding",
    probes: int = 4,
    approximate: bool = False,
) -> DataFrame:
    """``(key, distance, similarity)`` of the ``k`` nearest vectors in the index at ``path``.

    Reads the cell table (one row per cell, limited at build time) to the driver to choose the
    cells; the scans read the directories of those cells only.
    """
    table = spark.read.parquet(f"{path}/vectors")
    cells = [r for r in _cells(spark, path) if r.n]
    unit = unit_rows(query)[0]
    away = {r.cell: float(np.linalg.norm(unit - np.array(r.centre))) for r in cells if r.centre is not None}
    order = sorted(away, key=away.get)
    first = order[:probes]

    def scan(chosen: list[int]) -> DataFrame:
        return cosine_topk(table.where(F.col("cell").isin(chosen)), query, k, key, vector)

    if approximate:
        return scan(first)
    hits = scan(first).collect()
    # Cosine distance d of unit vectors is a Euclidean distance of sqrt(2 d).
    far = [r.distance for r in hits if not np.isnan(r.distance)]
    reach = np.sqrt(2 * (max(far) + _ROUNDING)) + _SLACK if len(far) == k else np.inf
    rest = [r.cell for r in cells if r.centre is None and reach == np.inf]
    rest += [r.cell for r in cells if r.centre is not None and r.cell not in first and away[r.cell] - r.radius <= reach]
    schema = scan(first).schema
    found = spark.createDataFrame(hits, schema)
    return found if not rest else found.unionByName(scan(rest)).orderBy("distance", key).limit(k)
