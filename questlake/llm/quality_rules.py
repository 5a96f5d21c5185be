"""Quality rules by gradient-boosted trees over document statistics.

Statistics of whole texts are counted where the texts are read. Two fixed base rules fail texts
that are too short or repeat themselves; what passes them is judged by a forest of boosted trees,
fitted on a bounded sample of labelled rows. The forest is monotonic in chosen statistics: more
symbols, repeats, shouting or doubled lines never raise a score. For scoring it is flattened into
arrays of nodes, and a batch of rows goes down all trees at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlake.llm.common import texts_of
from questlake.llm.quality import held_out
from questlake.llm.shingles import run_hashes, words_of

#: Fixed by the contract: the base rules, the symbols and the size of a repeated window.
LEAST_WORDS, MOST_REPEATED, SYMBOLS, WINDOW = 50, 50, b"#*$%&|<>", 3
#: The bounded sample that the forest is fitted on: at most so many labelled rows, chosen by a hash of the id.
FIT_ROWS = 20_000
TREES, DEPTH, RATE, RIDGE, BINS, LEAST_WEIGHT = 60, 4, 0.2, 1.0, 64, 2.0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: The features of the forest and how a score may move with each: 1 up, -1 down, 0 either way.
FEATURES = {
    "n_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_word_share": -1,
    "upper_share": -1,
    "shouts_per_word": -1,
    "digit_share": 0,
    "letter_share": 1,
    "pause_share": 0,
    "distinct_word_share": 0,
    "words_per_line": 0,
}


def _of(*ranges: tuple[int, int] | int) -> np.ndarray:
    found = np.zeros(256, bool)
    for r in ranges:
        low, high = r if isinstance(r, tuple) else (r, r)
        found[low : high + 1] = True
    return found


# A code point starts at every byte that is no continuation byte of UTF-8.
_CHARACTER = _of((0x00, 0x1F), (0x21, 0x7F), (0xC0, 0xFF))
_UPPER, _DIGIT, _SHOUT, _SYMBOL = _of((0x41, 0x5A)), _of((0x30, 0x39)), _of(0x21, 0x3F), _of(*SYMBOLS)
_LETTER = _of((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF))
_PAUSE = _of(*b".,;:")


def _lines(text: bytes) -> tuple[int, int]:
    """Lines that have a word, and those of them that equal an earlier one. ``bytes.strip`` strips what separates words."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def _repeated(runs: np.ndarray, words: int) -> int:
    """Words inside windows that occur twice or more, of the hashes of a text's windows."""
    _, where, times = np.unique(runs, return_inverse=True, return_counts=True)
    twice = times[where] > 1
    if not twice.any():
        return 0
    covered = np.zeros(words, bool)
    for k in range(WINDOW):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of each text of a column: the counts named in ``COUNTS`` and the features named in ``FEATURES``."""
    counts, features = [], []
    for words in words_of(column):
        rows = len(words.first) - 1
        data, first = np.frombuffer(words.text, np.uint8), words.first
        n = np.diff(first)
        some = n > 0
        begin, end = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        begin[some], end[some] = words.starts[first[:-1][some]], words.ends[first[1:][some] - 1]

        def inside(kind: np.ndarray, data: np.ndarray = data, begin: np.ndarray = begin, end: np.ndarray = end) -> np.ndarray:
            sums = np.r_[0, np.cumsum(kind[data], dtype=np.int64)]
            return sums[end] - sums[begin]

        characters, symbols, letters = inside(_CHARACTER), inside(_SYMBOL), inside(_LETTER)
        pauses = np.r_[0, np.cumsum(_PAUSE[data[words.ends - 1]], dtype=np.int64)] if len(words.ends) else np.zeros(1, np.int64)
        runs = run_hashes(words.hashes, WINDOW)
        lines, twice, repeated, distinct = (np.zeros(rows, np.int64) for _ in range(4))
        for i, text in enumerate(texts_of(column.slice(words.row, rows))):
            if some[i]:
                lines[i], twice[i] = _lines(text)
                repeated[i] = _repeated(runs[first[i] : max(first[i], first[i + 1] - WINDOW + 1)], int(n[i]))
                distinct[i] = len(np.unique(words.hashes[first[i] : first[i + 1]]))
        each, per_line, per_char = np.maximum(n, 1), np.maximum(lines, 1), np.maximum(characters, 1)
        counts.append(np.stack([n, characters, symbols, twice, repeated], axis=1))
        features.append(
            np.stack(
                [
                    n.astype(float),
                    characters / each,
                    symbols / each,
                    twice / per_line,
                    repeated / each,
                    inside(_UPPER) / np.maximum(letters, 1),
                    inside(_SHOUT) / each,
                    inside(_DIGIT) / per_char,
                    letters / per_char,
                    (pauses[first[1:]] - pauses[first[:-1]]) / each,
                    distinct / each,
                    n / per_line,
                ],
                axis=1,
            )
        )
    if not counts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate(counts), np.concatenate(features)


@dataclass(frozen=True)
class Forest:
    """All trees' nodes one after the other. A row goes ``left`` where its ``feature`` is at most
    ``threshold``; a leaf leads to itself, so that ``depth`` steps lead from every root to a leaf."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1, per row of features."""
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -500, 500)))

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for start in range(0, len(x), 4096):
            part = x[start : start + 4096]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                at = np.where(part[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total[start : start + 4096] += self.value[at].sum(axis=1)
        return total


class _Nodes:
    """The arrays of a forest while it grows."""

    def __init__(self) -> None:
        self.rows: list[list[float]] = []

    def leaf(self, value: float) -> int:
        at = len(self.rows)
        self.rows.append([0, 0.0, at, at, value])
        return at

    def split(self, at: int, feature: int, threshold: float, left: int, right: int) -> None:
        self.rows[at] = [feature, threshold, left, right, 0.0]

    def forest(self, roots: list[int], base: float, depth: int) -> Forest:
        table = np.array(self.rows or [[0, 0.0, 0, 0, 0.0]])
        feature, left, right = (table[:, i].astype(np.int32) for i in (0, 2, 3))
        return Forest(np.array(roots, np.int32), feature, table[:, 1], left, right, table[:, 4], base, depth)


def _grow(
    nodes: _Nodes,
    codes: np.ndarray,
    edges: list[np.ndarray],
    signs: Sequence[int],
    g: np.ndarray,
    h: np.ndarray,
    rows: np.ndarray,
    depth: int,
    low: float,
    high: float,
    rate: float,
) -> int:
    """Grow one tree over ``rows`` from gradients ``g`` and curvatures ``h``; weights stay within ``low`` and ``high``.

    A split on a constrained feature must order its two weights as the constraint says, and their middle
    bounds everything below either side, so that no later split turns the order round.
    """

    def weight(grad: np.ndarray, curve: np.ndarray) -> np.ndarray:
        return np.clip(-grad / (curve + RIDGE), low, high)

    def gain(grad: np.ndarray, curve: np.ndarray, w: np.ndarray) -> np.ndarray:
        return -(grad * w + (curve + RIDGE) * w * w / 2)

    all_g, all_h = g[rows].sum(), h[rows].sum()
    own = weight(all_g, all_h)
    at = nodes.leaf(float(own) * rate)
    if depth == 0 or all_h < 2 * LEAST_WEIGHT:
        return at
    best = (1e-6, -1, 0, 0.0, 0.0)
    for j, edge in enumerate(edges):
        if not len(edge):
            continue
        code = codes[rows, j]
        left_g = np.cumsum(np.bincount(code, g[rows], len(edge) + 1))[:-1]
        left_h = np.cumsum(np.bincount(code, h[rows], len(edge) + 1))[:-1]
        right_g, right_h = all_g - left_g, all_h - left_h
        wl, wr = weight(left_g, left_h), weight(right_g, right_h)
        won = gain(left_g, left_h, wl) + gain(right_g, right_h, wr) - gain(all_g, all_h, own)
        won[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT) | (signs[j] * (wr - wl) < 0)] = -np.inf
        cut = int(np.argmax(won))
        if won[cut] > best[0]:
            best = (float(won[cut]), j, cut, float(wl[cut]), float(wr[cut]))
    _, j, cut, wl, wr = best
    if j < 0:
        return at
    middle, sign = (wl + wr) / 2, signs[j]
    goes = codes[rows, j] <= cut
    bounds_left = (low, middle) if sign > 0 else (middle, high) if sign < 0 else (low, high)
    bounds_right = (middle, high) if sign > 0 else (low, middle) if sign < 0 else (low, high)
    left = _grow(nodes, codes, edges, signs, g, h, rows[goes], depth - 1, *bounds_left, rate)
    right = _grow(nodes, codes, edges, signs, g, h, rows[~goes], depth - 1, *bounds_right, rate)
    nodes.split(at, j, float(edges[j][cut]), left, right)
    return at


def boost(x: np.ndarray, y: np.ndarray, signs: Sequence[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Forest:
    """Boosted trees for labels 0 and 1 by second-order steps on the logistic loss, with splits at quantiles.
    Without labels of both classes there is nothing to tell apart, and the forest has no tree."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes, roots = _Nodes(), []
    if len(set(y.tolist())) == 2:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
        codes = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(x.shape[1])], axis=1)
        score, everything = np.full(len(y), base), np.arange(len(y))
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            root = _grow(nodes, codes, edges, signs, p - y, p * (1 - p), everything, depth, -np.inf, np.inf, rate)
            roots.append(root)
            score += nodes.forest([root], 0.0, depth).raw(x)
    return nodes.forest(roots, base, depth)


_STATS_SCHEMA = ", ".join([*(f"{c} long" for c in COUNTS), "features array<double>"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, features = statistics(batch.column("text"))
        columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
        columns |= {c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)}
        offsets = np.arange(len(features) + 1, dtype=np.int32) * len(FEATURES)
        columns["features"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(features.ravel()))
        yield pa.RecordBatch.from_pydict(columns)


def document_statistics(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the counts of ``COUNTS`` and the array ``features`` of each row; a NULL text has no words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_counted, f"doc_id {rows.dtypes[0][1]}, {_STATS_SCHEMA}")


def fit_rules(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> Forest:
    """Fit on at most ``rows`` labelled rows that are not held out (see ``held_out``), chosen by a hash of the id.

    Labels other than 0 and 1, rows without id and texts without words teach nothing. An id with two labels
    teaches both; of the texts of one id the one with the least features is taken. The sample's features, not
    its texts, come to the driver.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    usable = usable.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("quality")).distinct()
    sample = usable.orderBy(F.xxhash64("id"), "id", "quality").limit(rows)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sampled = texts.join(F.broadcast(sample.select("id").distinct()), "id", "left_semi")
    found = document_statistics(sampled, doc_id="id").where("n_words > 0")
    found = found.groupBy("doc_id").agg(F.min("features").alias("features"))
    fitted = found.join(F.broadcast(sample), found["doc_id"] == sample["id"]).select("id", "quality", "features").orderBy("id", "quality").toPandas()
    x = np.array(fitted["features"].tolist(), float).reshape(-1, len(FEATURES))
    return boost(x, fitted["quality"].to_numpy(float), list(FEATURES.values()))


def _judged(forest: Forest) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, features = statistics(batch.column("text"))
            failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
            score = forest.score(features)
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            columns |= {c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)}
            columns |= {"base_failed": pa.array(failed), "kept": pa.array(~failed & (score >= 0.5)), "score": pa.array(score)}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def apply_rules(docs: DataFrame, forest: Forest, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the counts of ``COUNTS``, ``base_failed``, ``kept`` and the forest's ``score``.

    A text fails the base rules with fewer than ``LEAST_WORDS`` words, or if more than ``MOST_REPEATED`` in a
    hundred words lie in windows of three words that occur twice or more in it; others are kept from a score of
    a half on. NULL and empty texts have no words and fail. All depends on the text alone, so repeated rows are
    judged alike; other columns are not read. Nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = ", ".join([f"doc_id {rows.dtypes[0][1]}", *(f"{c} long" for c in COUNTS), "base_failed boolean, kept boolean, score double"])
    return rows.mapInArrow(_judged(forest), schema)
