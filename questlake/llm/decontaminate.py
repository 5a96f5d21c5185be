"""Benchmark decontamination: training text is streamed through a suffix automaton of the test items.

A generalised suffix automaton holds every run of words of every item. Reading a document word by
word, it knows the longest run that ends at each word and occurs in some item. A run of at least
``window`` words is a hit on all of its words; an item of fewer words counts where it occurs whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import LOWER, PLAIN_TABLE, PLAIN_WORD, UPPER, plain_words, texts_of, written

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
COVERAGE = 20
#: Words of items in one automaton; a larger benchmark is searched in blocks of this size.
BLOCK_WORDS = 250_000


class SuffixAutomaton:
    """All runs of words of the given (item, words) pairs; transitions are kept in one dictionary."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        for _, words in items:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary))
        self.width = max(1, len(self.vocabulary))
        self.next: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        self._out: list[list[int]] = [[]]
        ends = [self._add([self.vocabulary[w] for w in words]) for _, words in items]
        self._mark(items, ends)
        del self._out

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        return len(self.length) - 1

    def _go(self, state: int, word: int, to: int) -> None:
        key = state * self.width + word
        if key not in self.next:
            self._out[state].append(word)
        self.next[key] = to

    def _split(self, state: int, word: int, child: int) -> int:
        """A copy of ``child`` for the runs that are no longer than those of ``state`` and ``word``."""
        copy = self._state(self.length[state] + 1, self.link[child])
        for w in self._out[child]:
            self._go(copy, w, self.next[child * self.width + w])
        self.link[child] = copy
        while state >= 0 and self.next.get(state * self.width + word) == child:
            self.next[state * self.width + word] = copy
            state = self.link[state]
        return copy

    def _add(self, words: list[int]) -> int:
        last = 0
        for word in words:
            child = self.next.get(last * self.width + word)
            if child is not None:
                last = child if self.length[child] == self.length[last] + 1 else self._split(last, word, child)
                continue
            new = self._state(self.length[last] + 1, 0)
            state = last
            while state >= 0 and state * self.width + word not in self.next:
                self._go(state, word, new)
                state = self.link[state]
            if state >= 0:
                child = self.next[state * self.width + word]
                exact = self.length[child] == self.length[state] + 1
                self.link[new] = child if exact else self._split(state, word, child)
            last = new
        return last

    def _mark(self, items: list[tuple[str, list[bytes]]], ends: list[int]) -> None:
        """At each state: the ancestor that stands for its last ``window`` words, the items that
        hold these words, and the short items that are a suffix of it."""
        n, window = len(self.length), self.window
        self.at_window = [-1] * n
        self.short: list[tuple[tuple[int, str], ...]] = [()] * n
        own: dict[int, set[tuple[int, str]]] = defaultdict(set)
        for (item, words), end in zip(items, ends, strict=True):
            if 0 < len(words) < window:
                own[end].add((len(words), item))
        for state in sorted(range(1, n), key=self.length.__getitem__):
            link = self.link[state]
            if self.length[state] >= window:
                self.at_window[state] = state if self.length[link] < window else self.at_window[link]
            self.short[state] = self.short[link] + tuple(own.get(state, ()))
        holders: dict[int, set[str]] = defaultdict(set)
        for item, words in items:
            state = 0
            for at, word in enumerate(words):
                state = self.next[state * self.width + self.vocabulary[word]]
                if at + 1 >= window:
                    holders[self.at_window[state]].add(item)
        self.holders = {state: tuple(found) for state, found in holders.items()}

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Hit spans as [start, end) over word positions, merged, and the items found."""
        vocabulary, following, link, length, width = self.vocabulary, self.next, self.link, self.length, self.width
        window, short = self.window, self.short
        spans: list[list[int]] = []
        found: set[str] = set()
        state = run = 0
        for at, text in enumerate(words):
            word = vocabulary.get(text)
            if word is None:
                state = run = 0
                continue
            to = following.get(state * width + word)
            if to is None:
                while to is None and state:
                    state = link[state]
                    to = following.get(state * width + word)
                run = length[state]
            if to is None:
                run = 0
                continue
            state, run = to, run + 1
            hit = 0
            if run >= window:
                hit = run
                found.update(self.holders[self.at_window[state]])
            if short[state]:
                for size, item in short[state]:
                    if size <= run:
                        hit = max(hit, size)
                        found.add(item)
            if hit:
                start = at + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, at + 1])
        return spans, found


def _merge(left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for start, end in sorted(left + right):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return merged


def _without(text: bytes, spans: list[list[int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span."""
    plain, kept, at, word, end = text.translate(PLAIN_TABLE), [], 0, 0, 0
    bounds = []
    for piece in plain.split():
        start = plain.index(piece, end)
        end = start + len(piece)
        bounds.append((start, end))
    for word, stop in spans:
        kept.append(text[at : bounds[word][0]])
        at = bounds[stop - 1][1]
    return b"".join([*kept, text[at:]])


def item_blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items as (id, words), in blocks of about ``block_words`` words. Longer items are cut into
    pieces that overlap by ``window - 1`` words, so that no window is lost."""
    words = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(PLAIN_WORD), F.lit(0))
    step = max(1, block_words - window + 1)
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), words.alias("words")).where("size(words) > 0")
    starts = F.expr(f"sequence(1, greatest(1, size(words) - {window - 1}), {step})")
    pieces = items.select("item", "words", F.explode(starts).alias("start"))
    pieces = written(pieces.selectExpr("item", f"slice(words, start, {step + window - 1}) AS words", "start"), "items")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // block_words)
    block = F.pmod(F.xxhash64("item", "start"), F.lit(max(1, blocks)))
    for b in range(blocks):
        rows = pieces.where(block == b).select("item", "words").toLocalIterator()
        yield [(row["item"], [w.encode() for w in row["words"]]) for row in rows]


def _scan(automaton, cleaned: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in batch.schema.names}
            counts, all_spans, all_items, texts = [], [], [], []
            before = zip(columns["spans"].to_pylist(), columns["items"].to_pylist(), strict=True)
            for text, (spans, items) in zip(texts_of(columns["text"]), before, strict=True):
                words = plain_words(text or b"")
                more, found = automaton.value.matches(words)
                if more:
                    spans, items = _merge(spans, more), sorted(found.union(items))
                counts.append(len(words))
                all_spans.append(spans)
                all_items.append(items)
                if cleaned:
                    texts.append(_without(text, spans).decode() if spans else None if text is None else text.decode())
            columns["n_words"] = pa.array(counts, pa.int64())
            columns["spans"] = pa.array(all_spans, pa.list_(pa.list_(pa.int64())))
            columns["items"] = pa.array(all_items, pa.list_(pa.string()))
            if cleaned:
                columns["clean_text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: int = COVERAGE,
    block_words: int = BLOCK_WORDS,
    clean: bool = False,
    records: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``spans`` (word positions hit, [start, end)
    pairs), ``items`` (ids found, as sorted strings), ``n_hit`` and ``contaminated``; with ``clean``
    also ``clean_text``, the text without the hit spans, with ``records`` also ``record``, a struct of
    all columns of ``docs``.

    NULL and empty texts have no words and no hits. Repeated rows each get their own row, NULL ids
    included. An empty benchmark hits nothing; items without words are ignored, items that share
    an id are one item, and a NULL item id is named by the empty string. An item is never longer
    in memory than a block, and a document is read as a stream of words: nothing is shuffled.
    """
    spark = docs.sparkSession
    state = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() AS array<array<bigint>>)").alias("spans"),
        F.expr("cast(array() AS array<string>)").alias("items"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")] if records else []),
    )
    blocks = item_blocks(benchmark, item_id, item_text, window, block_words)
    for done, items in enumerate(_with_empty(blocks)):
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(items, window))
        schema = _ddl(state) + ", clean_text string" * (clean and not done)
        state = (written(state, "scanned") if done else state).mapInArrow(_scan(automaton, clean), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0])
    counted = state.withColumn("n_hit", n_hit).drop("text")
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words")))


def _with_empty(blocks: Iterator[list]) -> Iterator[list]:
    first = next(blocks, [])
    yield first
    yield from blocks


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
