"""Phrase collocations, from counts in HAT-tries.

A task counts the windows of words that start at every word of its texts in a burst trie: a shallow trie of
word ids over hash containers. A container holds the windows of many first words; one that grows too large
bursts into children, by the first word and then by the second. When the trie is full, whole subtrees are
written as sorted runs, cut into slices of the space of two-word prefixes. The runs of a slice are merged in one
task, which keeps a prefix only if it is frequent. A slice that holds too many windows is first split, by another
hash of the prefix, and one that a single prefix fills by a hash of the whole window, whose prefixes are then
summed over tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from heapq import merge
from itertools import compress, groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlake.llm.common import hot_keys, lookup, texts_of, written
from questlake.llm.shingles import mixed

#: Fixed by the contract: longest phrase, least frequency, phrases per language, share of a longer phrase.
LONGEST, LEAST, TOP, INSIDE = 4, 30, 2000, 80
UNKNOWN = "und"
#: A container bursts beyond so many windows; a task writes subtrees beyond so many in all, or so many words.
BURST, FULL, MOST_WORDS = 8192, 1 << 18, 1 << 20
#: Bytes of text that a slice is planned for, the most slices, and the windows beyond which a slice is split:
#: so many or, if that is more, one in ``SPLIT_SHARE`` of all. Results do not depend on them.
SLICE_BYTES, MOST_SLICES, SPLIT_WINDOWS, SPLIT_SHARE = 2 << 20, 1 << 14, 1 << 20, 1 << 20
#: Words that wait to be counted, and bytes of a text that are split at a time, up to the end of a piece.
_BATCH, _CHUNK = 1 << 18, 1 << 20
_BITS = 21  # of a word's id
_LOW = (1 << _BITS) - 1
#: What the children of a trie's levels share: the upper bits of the first word's id, that id, both first ids.
_SHIFTS = (_BITS + 8, _BITS, 0)
# Separates words in a run. The byte itself may be part of a word and is there 0xFF, which UTF-8 does not use.
_NUL, _FREE, _END = b"\x00", b"\xff", b"\n"


def _prepare() -> bytes:
    """Of each byte: A-Z in lower case, what ends a piece as a line feed, a tab as a space."""
    table = bytearray(range(256))
    for byte in range(0x41, 0x5B):
        table[byte] |= 0x20
    for byte in b".,;:!?\x0a\x0b\x0c\x0d":
        table[byte] = 0x0A
    table[0x09], table[0x00] = 0x20, 0xFF
    return bytes(table)


_TABLE = _prepare()
_NAMED = bytes.maketrans(_NUL + _FREE, b" " + _NUL)


class _Ids(dict):
    """Numbers words in the order they come; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _keys(windows: np.ndarray) -> list[bytes]:
    """The containers' keys of windows of four ids: the first two and the last two, packed into 8 bytes each."""
    packed = np.stack([windows[:, 0] << _BITS | windows[:, 1], windows[:, 2] << _BITS | windows[:, 3]], axis=1)
    return np.ascontiguousarray(packed.astype(">i8")).view("V16").ravel().tolist()


def _windows(keys: Sequence[bytes]) -> np.ndarray:
    packed = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
    return np.stack([packed[:, 0] >> _BITS, packed[:, 0] & _LOW, packed[:, 1] >> _BITS, packed[:, 1] & _LOW], axis=1)


class HatTrie:
    """Counts of windows. ``children`` leads from an id, or the upper bits of one, to a container (a Counter of
    windows) or, where that has burst, to a node one level below."""

    def __init__(self, level: int = 0):
        self.level, self.children = level, {}

    def add(self, windows: np.ndarray, times: np.ndarray | None = None) -> int:
        """Count windows, once each or ``times``; returns how many new ones there are."""
        first = windows[:, 0] << _BITS | windows[:, 1]
        order = np.argsort(first, kind="stable")
        return self._add(first[order], _keys(windows[order]), None if times is None else times[order].tolist())

    def _add(self, first: np.ndarray, keys: list[bytes], times: list[int] | None) -> int:
        heads, new = first >> _SHIFTS[self.level], 0
        cuts = [0, *(np.flatnonzero(heads[1:] != heads[:-1]) + 1).tolist()] if len(heads) else []
        for head, start, end in zip(heads[cuts].tolist(), cuts, [*cuts[1:], len(heads)], strict=False):
            child = self.children.get(head)
            if child is None:
                child = self.children[head] = Counter()
            if isinstance(child, HatTrie):
                new += child._add(first[start:end], keys[start:end], times and times[start:end])
                continue
            before = len(child)
            child.update(keys[start:end] if times is None else dict(zip(keys[start:end], times[start:end], strict=True)))
            new += len(child) - before
            if len(child) > BURST and self.level + 1 < len(_SHIFTS):
                self.children[head] = node = HatTrie(self.level + 1)
                node.add(_windows(list(child)), np.fromiter(child.values(), np.int64))
        return new

    def containers(self) -> Iterator[Counter]:
        for child in self.children.values():
            if isinstance(child, HatTrie):
                yield from child.containers()
            else:
                yield child


_RUN_SCHEMA = "lang string, slice long, n long, words long, run binary"
_RUN = pa.schema([("lang", pa.string()), ("slice", pa.int64()), ("n", pa.int64()), ("words", pa.int64()), ("run", pa.binary())])


def _packed(heads: bytes, sizes: np.ndarray, rests: bytes, times: np.ndarray) -> bytes:
    """A run: for each head the number of its windows, the windows' counts, the heads, and what follows them."""
    lengths = np.array([len(sizes), len(times), len(heads)], "<i8").tobytes()
    return zstandard.compress(lengths + sizes.astype("<i8").tobytes() + times.astype("<i8").tobytes() + heads + rests, 1)


def _unpacked(run: bytes) -> tuple[bytes, np.ndarray, np.ndarray, bytes]:
    plain = zstandard.decompress(run)
    n_heads, n, length = np.frombuffer(plain, "<i8", 3).tolist()
    at = 24 + 8 * (n_heads + n)
    sizes, times = np.frombuffer(plain, "<i8", n_heads, 24), np.frombuffer(plain, "<i8", n, 24 + 8 * n_heads)
    return plain[at : at + length], sizes, times, plain[at + length :]


class _Vocabulary:
    """The words behind those ids of a task that some windows have: their order, their CRCs and their bytes."""

    def __init__(self, ids: _Ids, windows: np.ndarray):
        used = np.zeros(len(ids), bool)
        used[windows] = used[0] = True
        self.place = np.cumsum(used) - 1
        words = [*compress(ids, used.tolist())]
        words[0] = b""
        self.rank = np.empty(len(words), np.int64)
        self.rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        self.crcs = np.fromiter(map(crc32, words), np.uint64)
        self.plain = pa.array(words, pa.large_binary())
        self.after = pa.array([b"", *(_NUL + w for w in words[1:])], pa.large_binary())

    def texts(self, first: np.ndarray, second: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """Both words and a line feed, one row after the other, and where each row starts."""
        empty, end = pa.scalar(b"", pa.large_binary()), pa.scalar(_END, pa.large_binary())
        joined = pc.binary_join_element_wise(self.plain.take(pa.array(first)), self.after.take(pa.array(second)), end, empty)
        return memoryview(joined.buffers()[2]), np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]


class _Task:
    """The tries of one task, by language, and the runs that they leave."""

    def __init__(self, longest: int, full: int, slices: int):
        self.longest, self.full, self.slices = longest, full, slices
        self._reset()

    def _reset(self) -> None:
        self.ids = _Ids({_END: 0})
        self.tries: dict[str, HatTrie] = {}
        self.words: dict[str, np.ndarray] = {}
        self.waiting: dict[str, list[int]] = {}
        self.n_waiting = self.n_windows = 0

    def read(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        text = text.translate(_TABLE)
        start = 0
        while start < len(text):
            end = text.find(_END, start + _CHUNK)
            end = len(text) if end < 0 else end
            words = filter(None, text[start:end].replace(_END, b" \n ").split(b" "))
            waiting = self.waiting.setdefault(lang, [])
            before, start = len(waiting), end
            waiting.extend(map(self.ids.__getitem__, words))
            waiting.append(0)
            self.n_waiting += len(waiting) - before
            if self.n_waiting > _BATCH:
                yield from self.count()

    def count(self) -> Iterator[pa.RecordBatch]:
        """Put what waits into the tries; write subtrees if they are full."""
        for lang, waiting in self.waiting.items():
            size = len(waiting)
            ids = np.array(waiting + [0] * LONGEST, np.int64)
            columns = [ids[:size]]
            for k in range(1, LONGEST):
                columns.append(np.where(columns[-1] > 0, ids[k : k + size], 0) if k < self.longest else np.zeros(size, np.int64))
            windows = np.stack(columns, axis=1)
            self.n_windows += self.tries.setdefault(lang, HatTrie()).add(windows[(columns[0] > 0) & (columns[1] > 0)])
            counts = np.bincount(columns[0], minlength=len(self.ids))
            known = self.words.get(lang, np.zeros(0, np.int64))
            counts[: len(known)] += known
            counts[0] = 0
            self.words[lang] = counts
        self.waiting, self.n_waiting = {}, 0
        if len(self.ids) > MOST_WORDS:
            yield from self.finish()
        elif self.n_windows > self.full:
            yield from self.spill(self.full // 8)

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self.spill(0)
        for lang, counts in self.words.items():
            some = np.flatnonzero(counts)
            if len(some):
                zero = np.zeros(len(some), np.int64)
                yield self.runs(lang, np.stack([some, zero, zero, zero], axis=1), counts[some], single=True)
        self._reset()

    def spill(self, leave: int) -> Iterator[pa.RecordBatch]:
        """Write whole subtrees, the largest first, until at most ``leave`` windows stay."""
        sizes = [
            (sum(map(len, c.containers())) if isinstance(c, HatTrie) else len(c), lang, head) for lang, t in self.tries.items() for head, c in t.children.items()
        ]
        sizes.sort(reverse=True)
        chosen: dict[str, list[Counter]] = {}
        for size, lang, head in sizes:
            if self.n_windows <= leave:
                break
            self.n_windows -= size
            child = self.tries[lang].children.pop(head)
            chosen.setdefault(lang, []).extend(child.containers() if isinstance(child, HatTrie) else [child])
        for lang, containers in chosen.items():
            keys = [k for c in containers for k in c]
            if keys:
                yield self.runs(lang, _windows(keys), np.concatenate([np.fromiter(c.values(), np.int64) for c in containers]))

    def runs(self, lang: str, windows: np.ndarray, times: np.ndarray, single: bool = False) -> pa.RecordBatch:
        """One row per slice, its windows in order of their words' bytes; with ``single`` they are words."""
        known = _Vocabulary(self.ids, windows)
        windows = known.place[windows]
        first = known.crcs[windows[:, 0]] << np.uint64(32) | known.crcs[windows[:, 1]]
        of_slice = (mixed(first) % np.uint64(self.slices)).astype(np.int64)
        ranked = known.rank[windows]
        order = np.lexsort((ranked[:, 1] << 2 * _BITS | ranked[:, 2] << _BITS | ranked[:, 3], of_slice << _BITS | ranked[:, 0]))
        windows, times, of_slice = windows[order], times[order], of_slice[order]
        changes = np.any(windows[1:, :2] != windows[:-1, :2], axis=1) | (of_slice[1:] != of_slice[:-1])
        heads = np.r_[0, np.flatnonzero(changes) + 1]
        head_text, head_at = known.texts(windows[heads, 0], windows[heads, 1])
        rest_text, rest_at = known.texts(windows[:, 2], windows[:, 3])
        edges = np.r_[heads, len(times)]
        cuts = np.r_[0, np.flatnonzero(of_slice[heads][1:] != of_slice[heads][:-1]) + 1, len(heads)].tolist()
        rows = []
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            start, end = int(edges[low]), int(edges[high])
            n = int(times[start:end].sum())
            run = _packed(
                bytes(head_text[head_at[low] : head_at[high]]), np.diff(edges[low : high + 1]), bytes(rest_text[rest_at[start] : rest_at[end]]), times[start:end]
            )
            rows.append((lang, int(of_slice[start]), 0 if single else n, n if single else 0, run))
        return _batch(rows, _RUN)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _count(longest: int, full: int, slices: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = _Task(longest, full, slices)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text")), strict=True):
                if text:
                    yield from task.read(lang, text)
        yield from task.count()
        yield from task.finish()

    return run


def _heads(key: bytes) -> bytes:
    return key.partition(_NUL)[0]


def _merged(entries: list[tuple[bytes, int]], prefix: bytes, least: Sequence[int]) -> Iterator[tuple[bytes, int]]:
    """Phrases that go on from ``prefix``, from sorted ``(rest, count)``; ``least`` counts by depth."""
    for word, group in groupby(entries, lambda e: _heads(e[0])):
        found = list(group)
        n = sum(c for _, c in found)
        if n >= least[0]:
            phrase = prefix + _NUL + word
            yield phrase, n
            yield from _merged([(k[len(word) + 1 :], c) for k, c in found if len(k) > len(word)], phrase, least[1:])


def _phrases(runs: list[bytes], least: Sequence[int]) -> Iterator[tuple[bytes, int]]:
    """Merge the runs of a slice. Heads are summed first; only what follows frequent ones is merged."""
    opened = [_unpacked(run) for run in runs]
    text = b"".join(heads for heads, _, _, _ in opened)
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == _END[0]) + 1
    heads = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.r_[0, ends]), pa.py_buffer(text)])
    sums = np.concatenate([np.add.reduceat(times, np.cumsum(sizes) - sizes) for _, sizes, times, _ in opened])
    totals = pa.table({"head": heads, "n": pa.array(sums)}).group_by("head").aggregate([("n", "sum")])
    totals = totals.filter(pc.greater_equal(totals["n_sum"], min(least)))
    frequent = []
    for line, n in zip(totals["head"].to_pylist(), totals["n_sum"].to_pylist(), strict=True):
        if n >= least[0 if _NUL in line else -1]:
            yield line[:-1], n
            frequent += [line] if _NUL in line else []
    wanted = pc.is_in(heads, value_set=pa.array(frequent, pa.large_binary())).to_numpy(zero_copy_only=False)
    followed, start = [], 0
    for text, sizes, times, rest in opened:
        mine = np.flatnonzero(wanted[start : start + len(sizes)]).tolist()
        start += len(sizes)
        if mine:
            lines, rests, to = text.split(_END), rest.split(_END), np.cumsum(sizes).tolist()
            places = ((lines[i], j) for i in mine for j in range(to[i] - int(sizes[i]), to[i]))
            followed.append([(head, rests[j], int(times[j])) for head, j in places if rests[j]])
    for head, group in groupby(merge(*followed), itemgetter(0)):
        yield from _merged([(rest, n) for _, rest, n in group], head, least[1:])


def _merge(least: Sequence[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Merges one slice after the other; rows come sorted by language and slice. ``least`` are the counts that
    phrases of two, three and four words need; single words are held to the last. Phrases are named here: a second
    pass over the same rows would be a second worker for each task."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def merged(lang: str, runs: list[bytes]) -> pa.RecordBatch:
        return _batch([(lang, phrase.translate(_NAMED).decode(), n) for phrase, n in _phrases(runs, least)], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, runs = None, []
        for batch in batches:
            for lang, of_slice, packed in zip(*(batch.column(c) for c in ("lang", "slice", "run")), strict=True):
                if (lang.as_py(), of_slice.as_py()) != key:
                    if runs:
                        yield merged(key[0], runs)
                    key, runs = (lang.as_py(), of_slice.as_py()), []
                runs.append(packed.as_py())
        if runs:
            yield merged(key[0], runs)

    return run


def _split(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each run as ``pieces`` runs, by a hash of its heads or of ``whole`` windows; all are sorted as before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, of_slice, pieces, words, packed in zip(*(batch.column(c).to_pylist() for c in ("lang", "slice", "pieces", "words", "run")), strict=True):
                text, sizes, times, rest = _unpacked(packed)
                heads, rests = text.split(_END)[:-1], rest.split(_END)[:-1]
                of_head = np.repeat(np.arange(len(heads)), sizes)
                if whole:
                    hashes = np.fromiter((crc32(r, crc32(heads[h])) for h, r in zip(of_head.tolist(), rests, strict=True)), np.uint64, len(rests))
                else:
                    hashes = np.fromiter(map(crc32, heads), np.uint64, len(heads))[of_head]
                to = mixed(hashes ^ mixed(np.full(1, of_slice, np.int64).view(np.uint64))) % np.uint64(pieces)
                for piece in np.unique(to).tolist():
                    at = np.flatnonzero(to == piece)
                    own, of_own = np.unique(of_head[at], return_counts=True)
                    n = int(times[at].sum())
                    run = _packed(b"".join(heads[h] + _END for h in own.tolist()), of_own, b"".join(rests[i] + _END for i in at.tolist()), times[at])
                    rows.append((lang, of_slice << 20 | piece, 0 if words else n, words and n, run))
            yield _batch(rows, _RUN)

    return run


def phrase_counts(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    full: int = FULL,
    slice_bytes: int = SLICE_BYTES,
    split_windows: int = SPLIT_WINDOWS,
) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, n)`` of every phrase of one to ``longest`` words (two to four) that occurs ``least`` times
    or more, and ``(lang, n)``, the number of all words.

    A-Z are lower-cased; ``.,;:!?`` and line ends cut a text into pieces, spaces and tabs those into words. NULL
    and empty texts have no words; a NULL language is ``und``. Counts are exact, and rows that repeat count again.
    A task holds ``full`` windows and as many words, and merges ``split_windows`` windows at a time or, if that is
    more, one in ``SPLIT_SHARE`` of all; so at most ``SPLIT_SHARE`` slices are broadcast to be split.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    slices = min(MOST_SLICES, max(1, -(-size // slice_bytes)))
    runs = written(rows.mapInArrow(_count(longest, full, slices), _RUN_SCHEMA), "runs")
    total, words = runs.agg(F.sum("n")).first()[0] or 0, runs.groupBy("lang").agg(F.sum("words").alias("n"))
    limit = max(split_windows, total // SPLIT_SHARE)
    schema, found = "lang string, phrase string, n long", []
    for whole in (False, True, None):
        large = runs.groupBy("lang", "slice").agg(F.sum("n").alias("n")).where(F.col("n") > limit)
        large = large.select("lang", "slice", F.least(F.ceil(F.col("n") / limit), F.lit(1 << 20)).alias("pieces"))
        more = whole is not None and bool(large.take(1))
        fits = runs.join(F.broadcast(large), ["lang", "slice"], "left_anti") if more else runs
        fits = fits.select("lang", "slice", "run").repartition("lang", "slice").sortWithinPartitions("lang", "slice")
        if whole is None:
            # Windows of one prefix are in several pieces here: what is shorter than a window is summed first.
            parts = fits.mapInArrow(_merge([1, 1, least]), schema)
            found.append(parts.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
        else:
            found.append(fits.mapInArrow(_merge([least] * 3), schema))
        if not more:
            break
        runs = written(runs.join(F.broadcast(large), ["lang", "slice"]).mapInArrow(_split(whole), _RUN_SCHEMA), "runs")
    counts = found[0]
    for part in found[1:]:
        counts = counts.unionByName(part)
    return counts, words


def _key(phrase: Column) -> Column:
    """Phrase and language in one string; no phrase holds a line feed."""
    return F.concat(phrase, F.lit("\n"), F.col("lang"))


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, inside: int = INSIDE, **counting: int
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of two words or more is scored at the cut into two parts where that is lowest, of equal cuts at the
    first: ``floor(2000000 * a / (l + r))`` for the phrase's and its parts' counts. A phrase inside a longer one
    with at least ``inside`` in a hundred of its counts is left out. Ranks go by score, then count, both downwards,
    then by the phrase's bytes. Counts are those of ``phrase_counts``; an empty table gives no rows.
    """
    counts, words = phrase_counts(docs, text=text, lang=lang, least=least, longest=longest, **counting)
    counts = written(counts.withColumn("key", _key(F.col("phrase"))), "phrases")
    parts = F.split("phrase", " ")
    size = F.size("words")
    phrases = counts.withColumn("words", parts).where(size > 1)

    def run_of(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    cut = phrases.select("lang", "phrase", F.col("key").alias("of"), F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    side = lambda first, part: F.struct(F.lit(first).alias("first"), part.alias("part"))
    sides = F.array(side(True, run_of(F.lit(1), F.col("k"))), side(False, run_of(F.col("k") + 1, size - F.col("k"))))
    cut = cut.select("lang", "phrase", "of", "a", "k", F.inline(sides)).withColumn("key", _key(F.col("part"))).drop("part")
    cut = written(cut, "cuts")
    hot = counts.join(F.broadcast(hot_keys(cut, ["key"]).select("key")), "key", "left_semi").select("key", "n")
    met = lookup(cut, counts.select("key", "n"), "key", hot, ["n"])

    lengths = F.sequence(F.lit(2), size - 1)
    subs = F.flatten(F.transform(lengths, lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: run_of(i, m))))
    longer = phrases.where(size > 2).select("lang", F.col("n").alias("longer"), F.explode(subs).alias("sub"))
    # What is known of a phrase meets in one aggregation: its parts' counts and the longer ones around it.
    facts = met.unionByName(longer.select(_key(F.col("sub")).alias("of"), "longer"), allowMissingColumns=True)
    part = lambda k, first: F.max(F.when((F.col("k") == k) & (F.col("first") == first), F.col("n")))
    sums = [part(k, first).alias(f"{'l' if first else 'r'}{k}") for k in range(1, longest) for first in (True, False)]
    known = facts.groupBy("of").agg(F.max("lang").alias("lang"), F.max("phrase").alias("phrase"), F.max("a").alias("a"), F.max("longer").alias("longer"), *sums)
    known = known.where(F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside))
    score = "(cast(a as decimal(20,0)) * 2000000) div (cast(l{0} as decimal(20,0)) + cast(r{0} as decimal(20,0)))"
    cuts = [
        F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(score.format(k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in range(1, longest)
    ]
    scored = known.withColumn("best", F.array_min(F.array(*cuts))).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
