"""Substring duplicates: runs of words that another document had first are removed.

A window of words is looked up in a compressed index of all text that may hold it. Equal windows
have the same anchor, the least hash among their short runs of words; a document is cut into
segments of windows with one anchor. Only anchors that several documents have matter. Their
segments are dealt to shards by anchor; each shard indexes its distinct segments and searches them
backward, which gives for every window the range of its occurrences and so the first document
that has it. The answers meet the documents again by segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import hot_keys, lookup, shuffle_partitions, texts_of, written
from questlake.llm.fm_index import first_owners
from questlake.llm.shingles import Words, longs, members, range_keys, run_hashes, words_of

WINDOW, ANCHOR = 13, 5
#: Words in one index.
INDEX_WORDS = 200_000
#: An anchor that more than one in so many anchors of documents are is hot: its windows are dealt singly.
_HOT = 1 << 20
_NO_ID = np.iinfo(np.int64).max
_LEAST_BITS, _MOST_BITS = 20, 28


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("doc_id").fill_null(_NO_ID).to_numpy()


def _anchors(words: np.ndarray, window: int, size: int) -> np.ndarray:
    """The least hash of the runs of ``size`` words in each window."""
    least, width, wanted = run_hashes(words, size), 1, window - size + 1
    while 2 * width <= wanted:
        least = np.minimum(least[: max(0, len(least) - width)], least[width:])
        width *= 2
    rest = wanted - width
    return np.minimum(least[: max(0, len(least) - rest)], least[rest:]) if rest else least


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all windows, by their first word, and the row that each is in."""
    counts = np.maximum(0, np.diff(words.first) - window + 1)
    rows = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return np.arange(len(rows)) - np.repeat(ends - counts, counts) + words.first[rows], rows


def _count_anchors(window: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Anchors of the documents that a task holds, each with the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words in words_of(batch.column("text")):
                places, rows = _windows(words, window)
                anchors = _anchors(words.hashes, window, size)[places]
                order = np.lexsort((rows, anchors))
                anchors, rows = anchors[order], rows[order]
                found.append(anchors[np.r_[True, (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])][: len(anchors)]])
            anchors, docs = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": longs(anchors), "docs": pa.array(docs.astype(np.int64))})

    return run


class Segments(NamedTuple):
    """Segments of a piece of a batch: shard key, row of the batch, first and last word (exclusive)."""

    shards: np.ndarray
    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def _segments(words: Words, window: int, size: int, bitmap: bytes, hot: np.ndarray) -> Segments:
    """The segments whose anchor is in the bitmap, and maybe a few more."""
    places, rows = _windows(words, window)
    anchors = _anchors(words.hashes, window, size)[places]
    single = members(anchors, hot)
    keys = np.where(single, run_hashes(words.hashes, window)[places], anchors) if single.any() else anchors
    cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1]) | single[1:]][: len(keys)])
    bits = (anchors[cuts] & np.uint64(len(bitmap) * 8 - 1)).astype(np.int64)
    wanted = (np.frombuffer(bitmap, np.uint8)[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(bool)
    counts = np.diff(np.r_[cuts, len(keys)])[wanted]
    cuts = cuts[wanted]
    return Segments(keys[cuts], rows[cuts], places[cuts], places[cuts] + counts + window - 1)


def _index_rows(window: int, size: int, bitmap, hot) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct segments of the documents that a task holds, each with the least and largest id of
    its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            found: dict[bytes, list] = {}
            for words in words_of(batch.column("text")):
                cut = _segments(words, window, size, bitmap.value, hot.value)
                keys = range_keys(words.hashes, cut.starts, cut.ends).to_pylist()
                docs = ids[words.row + cut.rows].tolist()
                bounds = zip(words.starts[cut.starts].tolist(), words.ends[cut.ends - 1].tolist(), strict=True)
                for key, shard, doc, (start, end) in zip(keys, cut.shards.tolist(), docs, bounds, strict=True):
                    row = found.get(key)
                    if row is None:
                        found[key] = [shard, words.text[start:end], doc, doc]
                    elif doc < row[2]:
                        row[2] = doc
                    elif doc > row[3]:
                        row[3] = doc
            if found:
                shards, texts, least, most = zip(*found.values(), strict=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": longs(np.array(shards, np.uint64)),
                        "key": pa.array(list(found), pa.binary()),
                        "segment": pa.array(texts, pa.binary()),
                        "least": pa.array(least, pa.int64()),
                        "most": pa.array(most, pa.int64()),
                    }
                )

    return run


def _search(window: int, index_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From segments in order of shard key: those that a document has which is not the first to have
    all of their windows, with the first document of each window."""

    def answered(held: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
        rows = list(held.items())
        firsts = first_owners([r[2].split(b" ") for _, r in rows], np.array([r[0] for _, r in rows]), window)
        useful = [(key, first) for (key, r), first in zip(rows, firsts, strict=True) if first.min() < r[1]]
        if useful:
            keys, lists = zip(*useful, strict=True)
            flat = pa.array(np.concatenate(lists))
            offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32))
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "firsts": pa.ListArray.from_arrays(offsets, flat)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        words, last = 0, None
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("shard", "key", "segment", "least", "most"))
            for shard, key, segment, least, most in zip(*columns, strict=True):
                if shard != last and words >= index_words:
                    yield from answered(held)
                    held, words = {}, 0
                last = shard
                row = held.get(key)
                if row is None:
                    held[key] = [least, most, segment]
                    words += segment.count(b" ") + 2
                else:
                    row[0], row[1] = min(row[0], least), max(row[1], most)
        if held:
            yield from answered(held)

    return run


def _document_key(doc: int, text: bytes | None) -> bytes:
    return xxhash.xxh3_128_digest(doc.to_bytes(8, "big", signed=True) + (text or b""))


def _occurrences(window: int, size: int, bitmap, hot) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            documents = pa.array([_document_key(d, t) for d, t in zip(ids.tolist(), texts_of(batch.column("text")), strict=True)], pa.binary())
            for words in words_of(batch.column("text")):
                cut = _segments(words, window, size, bitmap.value, hot.value)
                rows = words.row + cut.rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": range_keys(words.hashes, cut.starts, cut.ends),
                        "document": documents.take(pa.array(rows)),
                        "id": pa.array(ids[rows]),
                        "start": pa.array(cut.starts - words.first[cut.rows]),
                    }
                )

    return run


def _whole(bitmap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents that lose no words, as the bitmap of those that do tells; a few of them are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            touched = _touched(batch, bitmap.value)
            rest = batch.filter(pa.array([not t for t in touched]))
            counts, kept = [], []
            for text in texts_of(rest.column("text")):  # one text's words at a time
                words = (text or b"").split()
                counts.append(len(words))
                kept.append(b" ".join(words))
            columns = {"doc_id": rest.column("doc_id"), "n_words": pa.array(counts, pa.int64())}
            columns |= {"n_removed": pa.array([0] * len(counts), pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    return run


def _cut(bitmap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The documents that ``_whole`` leaves out, with their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array(_touched(batch, bitmap.value)))
            ids = _ids(rest).tolist()
            keys = [_document_key(doc, text) for doc, text in zip(ids, texts_of(rest.column("text")), strict=True)]
            yield pa.RecordBatch.from_pydict({"doc_id": rest.column("doc_id"), "document": pa.array(keys, pa.binary()), "text": rest.column("text")})

    return run


def _touched(batch: pa.RecordBatch, bitmap: bytes) -> list[bool]:
    ids = _ids(batch).tolist()
    mask = len(bitmap) * 8 - 1
    found = []
    for doc, text in zip(ids, texts_of(batch.column("text")), strict=True):
        bit = int.from_bytes(_document_key(doc, text)[:4], "big") & mask
        found.append(bool(bitmap[bit >> 3] >> (bit & 7) & 1))
    return found


def _remove(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, starts in zip(texts_of(batch.column("text")), batch.column("starts").to_pylist(), strict=True):
                words = (text or b"").split()
                covered = np.zeros(len(words) + 1, np.int64)
                at = np.unique(np.array(starts or [], np.int64))
                np.add.at(covered, at, 1)
                np.add.at(covered, at + window, -1)
                stays = np.cumsum(covered)[: len(words)] == 0
                counts.append(len(words))
                removed.append(int(len(words) - stays.sum()))
                kept.append(b" ".join([words[i] for i in np.flatnonzero(stays)]).decode())
            columns = {"doc_id": batch.column("doc_id"), "n_words": pa.array(counts, pa.int64())}
            columns |= {"n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _bitmap(values: DataFrame, column: str, rows: int) -> bytes:
    """A bit for the low bits of each value; its size follows the number of values up to 32 MB."""
    bits = min(_MOST_BITS, max(_LEAST_BITS, (16 * rows).bit_length()))
    bit = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1  # these functions count from 1
    at = values.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("at"))
    out = bytearray(1 << (bits - 3))
    for row in at.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")).toLocalIterator():
        start = (row["bucket"] - 1) * 4096
        out[start : start + 4096] = row["bits"]
    return bytes(out)


def remove_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, anchor: int = ANCHOR, index_words: int = INDEX_WORDS
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``, the words that stay
    joined by one space. A word goes if a window over it also starts in a document of a smaller id.

    ``doc_id`` is an integer. A NULL id is larger than all others, so rows without id lose what any
    document with an id has, and never take from each other. Rows that repeat an id do not take
    from each other either. NULL and empty texts, and those of fewer words than a window, lose nothing.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    anchors = texts.mapInArrow(_count_anchors(window, anchor), "anchor long, docs long").groupBy("anchor").agg(F.sum("docs").alias("docs"))
    shared = written(anchors.where("docs > 1"), "anchors")
    n_shared, total = shared.agg(F.count(F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))).first()
    often = shared.where(F.col("docs") > max(64, total // _HOT)).select("anchor").toPandas()["anchor"].to_numpy(np.int64)
    bitmap = spark.sparkContext.broadcast(_bitmap(shared, "anchor", n_shared))
    hot = spark.sparkContext.broadcast(np.sort(often.view(np.uint64)))

    rows = texts.mapInArrow(_index_rows(window, anchor, bitmap, hot), "shard long, key binary, segment binary, least long, most long")
    rows = rows.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard")
    firsts = written(rows.mapInArrow(_search(window, index_words), "key binary, firsts array<long>"), "firsts")

    seen = texts.mapInArrow(_occurrences(window, anchor, bitmap, hot), "key binary, document binary, id long, start long")
    seen = written(seen, "occurrences")
    busy = hot_keys(seen, ["key"])
    met = lookup(seen, firsts, "key", firsts.join(F.broadcast(busy), "key", "left_semi"), ["firsts"])
    lost = F.filter(F.transform("firsts", lambda first, at: F.when(first < F.col("id"), F.col("start") + at)), lambda at: at.isNotNull())
    met = met.where("firsts IS NOT NULL").select("document", lost.alias("lost")).where("size(lost) > 0")
    starts = written(met.groupBy("document").agg(F.flatten(F.collect_list("lost")).alias("starts")), "starts")

    number = F.conv(F.hex(F.substring("document", 1, 4)), 16, 10).cast("long")
    touched = spark.sparkContext.broadcast(_bitmap(starts.select(number.alias("number")), "number", starts.count()))
    schema = "doc_id long, n_words long, n_removed long, kept_text string"
    cut = texts.mapInArrow(_cut(touched), "doc_id long, document binary, text string").join(starts, "document", "left")
    return texts.mapInArrow(_whole(touched), schema).union(cut.select("doc_id", "text", "starts").mapInArrow(_remove(window), schema))
