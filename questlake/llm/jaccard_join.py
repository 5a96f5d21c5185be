"""Near duplicates: a join of documents whose sets of word shingles overlap enough.

Candidates share a signature. Shingles are ordered by class, rare before frequent, then by hash.
Two sets that are similar enough cannot differ in more than a tenth of the smaller one, so each
set signs with a prefix of its order. A rare shingle of the prefix is a signature alone. Frequent
shingles sign in pairs from one of several groups of them: the prefix is extended until, whatever
tenth of it is missing in the other set, a rare one or a pair is left. Candidates that short
fingerprints cannot rule out are verified on whole sets. Equal sets are one class from the start, and each class enters with one set.

A fingerprint holds, for each value of the first bits of a hash, whether the set has an odd number
of such hashes. Each shingle that only one of two sets has flips one bit, so the bits in which two
fingerprints differ are no more than the shingles in which the sets do.

Of the documents that share a signature each is first compared with one centre. Documents found
in different components then meet each other, all others are connected already; they are
told apart by short fingerprints while they are joined, so a large group of near copies costs about one comparison
per copy, and no link between two components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import lookup, shuffle_partitions, written
from questlake.llm.components import components
from questlake.llm.shingles import long_lists, longs, members, mixed, set_key, shingle_sets, words_of

#: Fixed by the contract: words per shingle, and shared shingles in a hundred of both sets.
SIZE, PERCENT = 3, 90
#: A shingle is frequent if it was counted so often, or more than once in so many shingles.
_LEAST_FREQUENT, _MOST_FREQUENT = 16, 1 << 23
#: Shingles that are counted at a time.
_CHUNK = 1_000_000
#: Sets of up to so many bits of size sign with single shingles only: their prefixes are too short for pairs.
_SINGLES = 6
#: Frequent shingles of a prefix that a group of them holds, on average, are about four.
_GROUP = 53
_BITS = 26
#: The bits of a short fingerprint as a power of two, and the columns of longs that hold them.
_SHORT = 8
_MASK = [f"mask_{i}" for i in range((1 << _SHORT) // 64)]


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for words in words_of(batch.column("text"), lower=True):
            sets = list(shingle_sets(words, size))
            yield batch.slice(words.row, len(sets)), sets


def _scan(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per document: the key, the size and the fingerprints of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, size):
            columns = {n: batch.column(n) for n in ("doc_id", "row", "tag")}
            columns |= {"key": pa.array([set_key(s) for s in sets], pa.binary()), "n": pa.array([len(s) for s in sets], pa.int64())}
            columns["print"] = pa.array([fingerprint(s, max(_SHORT, len(s).bit_length())) for s in sets], pa.binary())
            short = np.frombuffer(b"".join(fingerprint(s, _SHORT) for s in sets), "<i8").reshape(-1, len(_MASK))
            columns |= {name: pa.array(short[:, i]) for i, name in enumerate(_MASK)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _sizes(n: int, percent: int) -> list[int]:
    """The powers of two of sizes that a set of ``n`` signs for: its own, and the next one if a similar
    set can be that large."""
    return sorted({n.bit_length(), (n * 100 // percent).bit_length()})


def tagged(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Shingles as signatures of sets of one power of two of sizes."""
    return mixed(tokens ^ mixed(np.array([bits], np.uint64)))


def _count(size: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How often single signatures occur in a chunk of sets: those of prefixes, which are taken a
    quarter longer than they must be, as taking out the frequent ones makes them longer; and all
    that several sets of the chunk have, as a large family of copies runs through its whole sets."""

    def counted(whole: list[np.ndarray], prefixes: list[np.ndarray]) -> pa.RecordBatch:
        signs = np.concatenate(whole)
        whole.clear()
        signs.sort()
        first = np.flatnonzero(np.r_[True, signs[1:] != signs[:-1]])
        times = np.diff(first, append=len(signs))
        signs = signs[first]
        del first
        keep = (times > 1) | members(signs, np.unique(np.concatenate(prefixes)))
        return pa.RecordBatch.from_pydict({"sign": longs(signs[keep]), "times": pa.array(times[keep].astype(np.int64))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        whole, prefixes, held = [], [], 0
        for _, sets in _sets(batches, size):
            for tokens in sets:
                key = set_key(tokens)
                if not len(tokens) or key in done:
                    continue
                done.add(key)
                need = len(tokens) - -(-len(tokens) * percent // 100) + 1
                for bits in _sizes(len(tokens), percent):
                    signs = tagged(tokens, bits)
                    whole.append(signs)
                    prefixes.append(signs[: need + need // 4 + 2])
                    held += len(signs)
                if held >= _CHUNK:
                    yield counted(whole, prefixes)
                    whole, prefixes, held = [], [], 0
        if held:
            yield counted(whole, prefixes)

    return run


def _pairs_within(tokens: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(groups, kind="stable")
    tokens, groups = tokens[order], groups[order]
    cuts = np.flatnonzero(groups[1:] != groups[:-1]) + 1
    left, right = [], []
    for members in np.split(tokens, cuts):
        i, j = np.triu_indices(len(members), 1)
        left.append(members[i])
        right.append(members[j])
    return np.concatenate(left), np.concatenate(right)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set, and for each how many shingles come before it in the set's order.

    ``frequent`` holds the single signatures that are frequent, sorted.
    """
    n = len(tokens)
    need = n - -(-n * percent // 100) + 1
    found, before = [], []
    for bits in _sizes(n, percent):
        signs = tagged(tokens, bits)
        common = members(signs, frequent)
        rare, often = signs[~common], signs[common]
        groups = (1 << bits) // _GROUP
        if bits <= _SINGLES or len(rare) >= need:
            prefix = np.concatenate([rare, often])[:need]
            found.append(prefix)
            before.append(np.arange(len(prefix)))
            continue
        group = often % np.uint64(groups)
        first = np.zeros(len(often), bool)
        first[np.unique(group, return_index=True)[1]] = True
        enough = int(np.searchsorted(np.cumsum(~first), need - len(rare)))
        left, right = _pairs_within(often[: enough + 1], group[: enough + 1])
        found += [rare, mixed(mixed(left) ^ right)]
        before += [np.arange(len(rare)), np.full(len(left), len(rare))]
    return np.concatenate(found), np.concatenate(before)


def _sign(size: int, percent: int, frequent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for _, sets in _sets(batches, size):
            keys, sizes, signed, before = [], [], [], []
            for found in sets:
                key = set_key(found)
                if not len(found) or key in done:
                    continue
                done.add(key)
                signs, places = signatures(found, frequent.value, percent)
                keys.append(key)
                sizes.append(len(found))
                signed.append(signs)
                before.append(places)
            if keys:
                each = np.repeat(np.arange(len(keys), dtype=np.int32), [len(x) for x in signed])
                yield pa.RecordBatch.from_pydict(
                    {
                        "sign": longs(np.concatenate(signed)),
                        "key": pa.array(keys, pa.binary()).take(pa.array(each)),
                        "n": pa.array(np.array(sizes, np.int64)[each]),
                        "pos": pa.array(np.concatenate(before).astype(np.int64)),
                    }
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of signature: those of signatures that more than one set has, each with the
    first of them as ``centre``; ``many`` is false only if no set but these two has the signature."""
    held: pa.RecordBatch | None = None
    last = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if batch.num_rows < 2:
            held = batch if batch.num_rows else held
            continue
        rows, held = batch[:-1], batch[-1:]
        yield from _with_centres(rows, held, last)
        sign = rows.column("sign").to_numpy()
        if last is None or last[0] != sign[-1]:
            last = (sign[-1], rows.slice(int(np.searchsorted(sign, sign[-1])), 1))
    if held is not None and held.num_rows:
        yield from _with_centres(held, held[:0], last)


def _with_centres(rows: pa.RecordBatch, following: pa.RecordBatch, last) -> Iterator[pa.RecordBatch]:
    """``rows`` that share their signature with the row before or after; ``last`` is the signature of
    the row before them with its centre."""
    sign = rows.column("sign").to_numpy()
    if not len(sign):
        return
    going_on = last is not None and last[0] == sign[0]
    starts = np.flatnonzero(np.r_[True, sign[1:] != sign[:-1]])
    centre = starts[np.cumsum(np.r_[True, sign[1:] != sign[:-1]]) - 1]
    after = np.r_[sign[1:], following.column("sign").to_numpy()]
    same_after = np.zeros(len(sign), bool)
    same_after[: len(after)] = sign[: len(after)] == after
    is_start = np.arange(len(sign)) == centre
    keep = ~is_start | same_after
    if going_on:
        keep[0] = True
    many = ~is_start & ((np.arange(len(sign)) > centre + 1) | same_after)
    if going_on:
        many[centre == 0] = True
    columns = {n: rows.column(n) for n in ("sign", "key", "n", "pos")} | {"many": pa.array(many)}
    for name in ("key", "n", "pos"):
        taken = rows.column(name).take(pa.array(centre))
        if going_on:
            head = int(np.searchsorted(centre, 1))  # rows of the signature that goes on
            first = last[1].column(name).take(pa.array(np.zeros(head, np.int32)))
            taken = pa.concat_arrays([first, taken[head:]])
        columns[f"centre_{name}"] = taken
    yield pa.RecordBatch.from_pydict(columns).filter(pa.array(keep))


def fingerprint(tokens: np.ndarray, bits: int) -> bytes:
    """For each value of the first ``bits`` bits: whether an odd number of a set's hashes begin with it."""
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def least_different(left: bytes, right: bytes) -> int:
    """No more than the hashes that only one of two sets has, from their fingerprints."""
    a, b = (np.unpackbits(np.frombuffer(x, np.uint8)) for x in sorted((left, right), key=len))
    return int(np.count_nonzero(a ^ (b.reshape(len(a), -1).sum(axis=1) & 1)))


def _near(percent: int, different: str, sizes: str) -> str:
    """Whether sets with so many members in all, of which ``different`` are not shared, are linked."""
    return f"{100 + percent} * ({different}) <= {100 - percent} * ({sizes})"


def _near_prints(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("left", "right", "sizes")]
            keep = [(100 + percent) * least_different(a, b) <= (100 - percent) * n for a, b, n in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in ("u", "v")}).filter(pa.array(keep, pa.bool_()))

    return run


def _by_set(left: pa.Scalar, right: pa.Scalar) -> tuple[int, int, float]:
    a, b = left.values.to_numpy(), right.values.to_numpy()
    at = np.searchsorted(b, a)
    return len(a), len(b), int((b[np.minimum(at, len(b) - 1)] == a).sum())


def _similar(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                n, m, both = _by_set(left, right)
                keep.append((100 + percent) * both >= percent * (n + m))
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in ("u", "v")}).filter(pa.array(keep, pa.bool_()))

    return run


def _emit(size: int, wanted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sets whose key's first bits are in a bitmap: all that are wanted, and a few more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = wanted.value
        done: set[bytes] = set()
        for _, sets in _sets(batches, size):
            found = {}
            for tokens in sets:
                key = set_key(tokens)
                bit = int.from_bytes(key[:4], "big") >> (32 - _BITS)
                if len(tokens) and key not in done and bitmap[bit >> 3] >> (bit & 7) & 1:
                    done.add(key)
                    found[key] = np.sort(tokens.view(np.int64)).view(np.uint64)
            if found:
                yield pa.RecordBatch.from_pydict({"key": pa.array(list(found), pa.binary()), "body": long_lists(list(found.values()))})

    return run


def _bitmap(keys: DataFrame) -> bytearray:
    """A bit for the first bits of each key: 8 MB, however many keys there are."""
    bit = F.shiftright(F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("long"), 32 - _BITS) + 1  # these functions count from 1
    at = keys.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("at"))
    bits = bytearray(1 << (_BITS - 3))
    for row in at.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).toLocalIterator():
        start = (row["bucket"] - 1) * 4096
        bits[start : start + 4096] = row["bits"]
    return bits


def _possible(percent: int) -> str:
    """Whether two sets whose first common signature these are can share enough."""
    return f"{100 + percent} * least(n - pos, centre_n - centre_pos) >= {percent} * (n + centre_n)"


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT, tag: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``row`` (its number in the input), ``n_shingles``, ``component_id``
    (the least id that links lead to, its own included), ``class_size`` (rows with the same set) and
    ``kept`` (true for one row of each component); with ``tag`` also that column of longs, as ``tag``.

    Two sets are linked if ``100 * shared >= percent * all``. A NULL text, or one without words, has
    an empty set, is linked with nothing and stays. NULL ids come last: a component is named NULL
    only if it has no other id. Rows that repeat an id are rows of their own; one of them is kept.
    Sets are held as 64-bit hashes of shingles.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), *([tag] if tag else []))
    kind = dict(texts.dtypes)["doc_id"]
    numbered = texts.withColumns({"row": F.monotonically_increasing_id(), "tag": F.col(tag) if tag else F.lit(0).cast("long")})
    rows = written(numbered.mapInArrow(_scan(size), f"doc_id {kind}, row long, tag long, key binary, n long, print binary, {', '.join(f'{c} long' for c in _MASK)}"), "sets")
    prints = rows.where("n > 0").groupBy("key").agg(*[F.first(c).alias(c) for c in ("n", "print", *_MASK)])
    prints = written(prints, "prints")

    counted = texts.select("text").mapInArrow(_count(size, percent), "sign long, times long")
    counted = written(counted.groupBy("sign").agg(F.sum("times").alias("times")).where(F.col("times") >= _LEAST_FREQUENT), "frequent")
    # At most 2 ** 23 of them, as each takes its part of all shingles: this bounds the broadcast.
    least = 2 * (rows.agg(F.sum("n")).first()[0] or 0) / _MOST_FREQUENT
    often = counted.where(F.col("times") >= least).select("sign").toPandas()["sign"]
    frequent = spark.sparkContext.broadcast(np.sort(often.to_numpy(np.int64).view(np.uint64)))

    signed = texts.select("text").mapInArrow(_sign(size, percent, frequent), "sign long, key binary, n long, pos long")
    signed = signed.repartition(shuffle_partitions(spark), "sign").dropDuplicates(["sign", "key"])
    schema = "sign long, key binary, n long, pos long, many boolean, centre_key binary, centre_n long, centre_pos long"
    shared = signed.sortWithinPartitions("sign", "pos", "key").mapInArrow(_shared, schema)
    shared = written(shared, "signatures")

    frequent.destroy()

    def possible(pairs: DataFrame) -> DataFrame:
        """The pairs that may be linked by their fingerprints."""
        one = pairs.join(prints.select(F.col("key").alias("u"), F.col("n").alias("n_u"), F.col("print").alias("left")), "u")
        both = one.join(prints.select(F.col("key").alias("v"), F.col("n").alias("n_v"), F.col("print").alias("right")), "v")
        both = both.select("u", "v", "left", "right", (F.col("n_u") + F.col("n_v")).alias("sizes"))
        return written(both.mapInArrow(_near_prints(percent), "u binary, v binary"), "possible")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs that are linked by their whole sets; only the sets of pairs that may be leave their task."""
        pairs = possible(pairs)
        keys = written(pairs.select(F.col("u").alias("key")).union(pairs.select("v")).distinct(), "keys")
        wanted = spark.sparkContext.broadcast(_bitmap(keys))
        emitted = texts.select("text").mapInArrow(_emit(size, wanted), "key binary, body array<long>")
        bodies = written(emitted.join(keys, "key").groupBy("key").agg(F.first("body").alias("body")), "bodies")
        wanted.destroy()
        one = pairs.join(bodies.select(F.col("key").alias("u"), F.col("body").alias("left")), "u")
        both = one.join(bodies.select(F.col("key").alias("v"), F.col("body").alias("right")), "v")
        return written(both.select("u", "v", "left", "right").mapInArrow(_similar(percent), "u binary, v binary"), "links")

    pair = [F.least("key", "centre_key").alias("u"), F.greatest("key", "centre_key").alias("v")]
    to_centre = written(shared.where("key <> centre_key").where(_possible(percent)).select(*pair).distinct(), "pairs")
    first = verified(to_centre)
    named = written(components(first), "components")

    # Of signatures whose sets are in several components yet, those outside the centre's component
    # meet all others but the centre, which was compared with each. Short fingerprints rule pairs out in the join.
    placed = shared.where("many").drop("many").join(named.withColumnsRenamed({"node": "key", "component": "own"}), "key", "left")
    placed = placed.join(named.withColumnsRenamed({"node": "centre_key", "component": "of_centre"}), "centre_key", "left")
    placed = placed.withColumns({"own": F.coalesce("own", "key"), "of_centre": F.coalesce("of_centre", "centre_key")})
    placed = written(placed.select("sign", "key", "pos", "own", (F.col("own") != F.col("of_centre")).alias("outer")), "placed")
    open_ = placed.groupBy("sign").agg(F.max("outer").alias("open")).where("open").select("sign")
    placed = written(placed.join(open_, "sign", "left_semi").join(prints.select("key", "n", *_MASK), "key"), "met")
    names = {c: f"centre_{c}" for c in ("key", "n", "pos", "own", *_MASK)}
    outer = placed.where("outer").select("sign", *[F.col(c).alias(name) for c, name in names.items()])
    different = " + ".join(f"bit_count({c} ^ centre_{c})" for c in _MASK)
    meet = placed.join(outer, "sign").where("own <> centre_own AND (NOT outer OR key < centre_key)")
    meet = meet.where(_possible(percent)).where(_near(percent, different, "n + centre_n"))
    second = verified(written(meet.select(*pair).distinct().join(to_centre, ["u", "v"], "left_anti"), "pairs"))
    links = first.union(second)
    named = components(links).withColumnRenamed("node", "key")

    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    some = rows.where("n > 0").select("doc_id", "row", "tag", "key", "n")
    classes = written(some.groupBy("key").agg(least.alias("least"), F.count(F.lit(1)).alias("class_size")), "classes")
    joined = classes.join(named, "key", "left").withColumn("component", F.coalesce("component", "key"))
    heads = joined.join(named.select("component").distinct(), "component", "left_semi")
    heads = heads.groupBy("component").agg(F.min("least").alias("head"))
    joined = joined.join(heads, "component", "left").withColumn("head", F.coalesce("head", "least"))
    found = joined.select("key", F.col("head.doc_id").alias("component_id"), F.col("head.row").alias("head_row"), "class_size")
    found = written(found, "found")
    n_all = rows.count()
    answered = lookup(some, found, "key", found.where(F.col("class_size") * 1000 > n_all), ["component_id", "head_row", "class_size"])
    answered = answered.select("doc_id", "row", F.col("n").alias("n_shingles"), "component_id", "class_size", (F.col("row") == F.col("head_row")).alias("kept"), "tag")
    empty = rows.where("n = 0").select("doc_id", "row", F.col("n"), F.col("doc_id"), F.lit(1).cast("long"), F.lit(True), "tag")
    return answered.union(empty) if tag else answered.union(empty).drop("tag")
