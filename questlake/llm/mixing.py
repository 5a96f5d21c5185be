"""Mixing sources to target weights by entropy balancing.

Every document starts at rate 1. The rates closest to that in relative entropy, between 0 and
``cap``, whose words add up to each source's target are tilted exponentially in the document's
size: ``cap * s / (1 + s)`` with ``s = exp(lambda * size) / (cap - 1)``. The convex dual has one
multiplier per source, which Newton steps find. Each step is one aggregation over the sizes that
occur per source, not over documents. The rates are then rounded to whole copies in slices of a
source, large documents first, each making up for what the ones before are off.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import lookup, word_count, written
from questlake.operators.rank import global_rank

WEIGHTS = (3, 1, 2)
SHARE, CAP, SEED = 1.5, 2.0, 20
#: Every source comes this close to its target, relatively, or as close as doubles can tell. After so many
#: Newton steps its bracket is only halved, which always ends.
CLOSE, STEPS = 1e-7, 60
#: Rows of a source that are rounded together, about; which ones is up to a hash of their ids and sizes.
SLICE_ROWS = 50_000
_STATE = ["source_size", "target", "mean_size", "lam", "slices"]


def _source_key(source: str) -> Column:
    """Never NULL, and in order of code points with NULL last."""
    return F.coalesce(F.concat(F.lit("a"), F.col(source).cast("string")), F.lit("b"))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """``skey, source_size, n_docs, weight, target`` from rows of ``skey, size``.

    A target is ``weight * level`` but at most ``cap`` times the source's size; the level is
    raised until the targets add up to ``share`` of all sizes.
    """
    sources = sizes.groupBy("skey").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = global_rank(sources, [F.col("skey")], "rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = written(ranked.withColumn("weight", weight.cast("long")).drop("rank"), "sources")
    wanted = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, -1.0
    while level != before:
        before = level
        full = F.col("source_size") * cap < F.col("weight") * level
        capped, free = sources.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        level = max(level, (wanted - cap * (capped or 0)) / free)
    return sources.withColumn("target", F.least(F.col("source_size") * cap, F.col("weight") * level))


def _rate(cap: float) -> Column:
    """Of a document of ``size`` in a source with multiplier ``lam``; all or nothing at the bounds."""
    tilt = F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("lam") * F.col("size") / F.col("mean_size"))))
    inside = cap * tilt / (cap - 1 + tilt)
    return F.when(F.col("target") >= F.col("source_size") * cap, F.lit(float(cap))).when(F.col("target") <= 0, 0.0).otherwise(inside)


def balance(sizes: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """``targets`` with the multiplier ``lam`` of each source. A step that would leave the bracket
    known to hold the multiplier is replaced by halving it."""
    histogram = written(sizes.groupBy("skey", "size").agg(F.count(F.lit(1)).alias("n")).where("size > 0"), "histogram")
    mean = F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1))
    slices = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / SLICE_ROWS))
    start = targets.withColumn("slices", slices).withColumns({"mean_size": F.greatest(mean, F.lit(1e-9)), "lam": F.lit(0.0), "lo": F.lit(-float("inf")), "hi": F.lit(float("inf"))})
    state = written(start, "multipliers")
    rate = _rate(cap)
    slope = rate * (1 - rate / cap) * F.col("size") / F.col("mean_size")
    exact = lambda c: F.sum((F.col("n") * F.col("size") * c).cast("decimal(38,9)")).cast("double")
    n_all = state.agg(F.sum("n_docs")).first()[0] or 0
    for taken in count():
        rows = lookup(histogram, state, "skey", state.where(F.col("n_docs") * 1000 > n_all), _STATE)
        sums = rows.groupBy("skey").agg(exact(rate).alias("got"), exact(slope).alias("slope"))
        now = state.join(sums, "skey", "left").withColumn("off", F.col("got") - F.col("target"))
        open_ = F.col("got").isNotNull() & (F.col("target") > 0) & (F.col("target") < F.col("source_size") * cap)
        open_ = open_ & (F.abs("off") > CLOSE * F.col("target"))
        open_ = open_ & ~(F.col("hi") - F.col("lo") <= 1e-15 * F.abs("lam"))
        lo = F.when(F.col("off") < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(F.col("off") > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - F.col("off") / F.col("slope")
        inside = F.lit(taken < STEPS) & (F.col("slope") > 0) & (step > lo) & (step < hi) & (F.abs(step - F.col("lam")) <= 2 + 2 * F.abs("lam"))
        double = F.when(F.col("off") < 0, F.col("lam") + 1 + F.abs("lam")).otherwise(F.col("lam") - 1 - F.abs("lam"))
        middle = F.when((lo > -float("inf")) & (hi < float("inf")), (lo + hi) / 2).otherwise(double)
        moved = now.withColumns({"lam": F.when(open_, F.when(inside, step).otherwise(middle)).otherwise(F.col("lam")), "lo": lo, "hi": hi, "moving": open_})
        state = written(moved.drop("got", "slope", "off"), "multipliers")
        if not state.where("moving").take(1):
            break
        state = state.drop("moving")
    return state.drop("moving")


def _rounded(cap: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rounds rates up or down, large documents first, so that the words taken from each slice of a
    source follow the words its rates ask for: what one document is off is made up by the next
    ones, and what stays open at the end is about half of one of the smallest documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, owed = None, 0.0
        for batch in batches:
            copies = []
            columns = {n: batch.column(n) for n in batch.schema.names}
            rows = zip(*(columns[n].to_pylist() for n in ("skey", "slice", "size", "rate", "chance")), strict=True)
            for key, part, size, rate, chance in rows:
                if (key, part) != source:
                    source, owed = (key, part), 0.0
                low = math.floor(rate)
                if size:
                    owed += size * rate
                    taken = low + (rate > low and owed - size * low > size / 2)
                    owed -= size * taken
                else:
                    taken = low + (chance < rate - low)
                copies.append(min(taken, math.floor(cap)))
            columns["copies"] = pa.array(copies, pa.int32())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def mix(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
    tag: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``source``, ``row`` (its number in the input), ``size`` (words),
    ``source_size``, ``target`` (its source's), ``rate`` and ``copies``; with ``tag`` also that column, as ``tag``.

    A NULL text has no words; a document without words has rate 1 and one copy, unless its source
    is at a bound. The NULL source is the last source. A seeded hash of the id orders documents of
    equal size. Copies are whole numbers from 0 to ``cap``. An empty table gives an empty result.

    Rates are rounded in slices of a source that depend on ids and sizes alone, so a rerun gives the same copies however
    the rows are partitioned; of rows that repeat an id and size, any may be the one that is taken more often.
    """
    sizes = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        _source_key(source).alias("skey"),
        word_count(F.col(text).cast("string")).alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id)).alias("lot"),
        F.monotonically_increasing_id().alias("row"),
        *([F.col(tag).alias("tag")] if tag else []),
    )
    sizes = written(sizes, "sizes")
    state = balance(sizes, source_targets(sizes, weights, share, cap), cap)
    n_all = state.agg(F.sum("n_docs")).first()[0] or 0
    rated = lookup(sizes, state, "skey", state.where(F.col("n_docs") * 1000 > n_all), _STATE).withColumn("rate", _rate(cap))
    chance = F.pmod(F.col("lot"), F.lit(1 << 20)) / (1 << 20)
    part = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), F.col("slices"))
    rated = rated.withColumns({"slice": part, "chance": chance}).drop("mean_size", "lam", "slices")
    order = [F.col("skey"), F.col("slice"), F.col("size").desc(), F.col("lot"), F.col("row")]
    schema = ", ".join(f"{n} {t}" for n, t in rated.dtypes) + ", copies int"
    placed = rated.repartition("skey", "slice").sortWithinPartitions(*order).mapInArrow(_rounded(cap), schema)
    return placed.select("doc_id", "source", "row", "size", "source_size", "target", "rate", "copies", *(["tag"] if tag else []))
