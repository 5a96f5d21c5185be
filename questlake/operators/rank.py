"""Row numbers over the whole table and within groups, without a one-task sort.

``row_number()`` over an unpartitioned window sorts the whole table in one task, and over a
window partitioned by a hot group sorts that group in one task. Here the rows are range
partitioned on the sort key, sorted per partition and written once with their position and the number of
rows of their group before them in the partition; the counts of the partitions, which are few, then turn
these into ranks. Rows are shuffled once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from questlake.session import materialise

#: Starts of groups in range partitions that are broadcast at most; more of them are joined by a shuffle.
BROADCAST_STARTS = 1 << 20
_POS, _PART, _COUNT, _BEFORE, _LOCAL = "_pos", "_part", "_count", "_before", "_local"
# monotonically_increasing_id: partition number above the lowest 33 bits, row number in them.
_ROW_BITS = 33


def _before(window) -> Column:
    earlier = F.sum(_COUNT).over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(earlier, F.lit(0)).alias(_BEFORE)


@F.pandas_udf(T.LongType())
def _rows_before(groups: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """How many rows of the same group the task has seen before each row. Only the group columns go to
    Python, as one JSON text per row; the task keeps one number per group of its partition."""
    seen: Counter[str] = Counter()
    for keys in groups:
        codes, names = pd.factorize(keys)
        earlier = np.array([seen[n] for n in names], np.int64)
        yield pd.Series(keys.groupby(codes).cumcount().to_numpy() + earlier[codes])
        seen.update(dict(zip(names, np.bincount(codes, minlength=len(names)).tolist(), strict=True)))


def _group_key(groups: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(g).cast("string").alias(f"g{i}") for i, g in enumerate(groups)]))


def rank_rows(
    df: DataFrame,
    order: Sequence[Column],
    overall: str | None = None,
    within: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add the 1-based rank over the whole table (``overall``) and within groups (``within``:
    name of the rank to group columns), all by ``order``.

    ``order`` should end in a unique column: ties have no defined order, and rows equal in
    all of it cannot be split over partitions. Group columns are told apart by their text. Runs one job (the
    placed rows are written to the shared folder). For one rank within groups the rows are sorted by group
    first, so that no more groups than partitions lie in several of them. Broadcasts one row per range partition
    and, for ranks within groups, one per group and partition that other partitions come before, up to a bound.
    """
    columns, within = list(df.columns), within or {}
    leading = [F.col(g) for g in next(iter(within.values()))] if len(within) == 1 and not overall else []
    by = [*leading, *order]
    sorted_rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(_POS, F.monotonically_increasing_id())
    before = _rows_before.asNondeterministic()
    locals_ = {f"{_LOCAL}{i}": before(_group_key(groups)) for i, groups in enumerate(within.values())}
    placed = materialise(sorted_rows.withColumns(locals_) if locals_ else sorted_rows, "ranked")
    ranked = numbered = placed.withColumn(_PART, F.shiftright(_POS, _ROW_BITS))

    if overall:
        sizes = numbered.groupBy(_PART).agg(F.count("*").alias(_COUNT))
        starts = sizes.select(_PART, _before(Window.orderBy(_PART)))
        in_part = F.col(_POS).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        ranked = ranked.join(F.broadcast(starts), _PART).withColumn(overall, F.col(_BEFORE) + in_part + 1).drop(_BEFORE)

    for i, (name, groups) in enumerate(within.items()):
        sizes = numbered.groupBy(_PART, *groups).agg(F.count("*").alias(_COUNT))
        starts = sizes.select(
            F.col(_PART).alias("_p"),
            *[F.col(g).alias(f"_g_{g}") for g in groups],
            _before(Window.partitionBy(*groups).orderBy(_PART)),
        )
        counted = Observation()
        starts = materialise(starts.where(F.col(_BEFORE) > 0).observe(counted, F.count(F.lit(1)).alias("n")), "starts")
        same = F.col(_PART) == F.col("_p")
        for g in groups:
            same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
        small = F.broadcast(starts) if counted.get["n"] <= BROADCAST_STARTS else starts
        ranked = ranked.join(small, same, "left").withColumn(name, F.coalesce(_BEFORE, F.lit(0)) + F.col(f"{_LOCAL}{i}") + 1)
        ranked = ranked.drop(_BEFORE, "_p", *[f"_g_{g}" for g in groups])

    return ranked.select(*columns, *([overall] if overall else []), *within)


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "overall_rank") -> DataFrame:
    return rank_rows(df, order, overall=name)


def rank_in_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    return rank_rows(df, order, within={name: groups})
