"""Resampling, phrases and quality rules against plain versions of themselves, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from questlake.llm import phrases, quality_rules
from questlake.llm.phrases import HatTrie, collocations, phrase_counts
from questlake.llm.quality_rules import FEATURES, apply_rules, boost, document_statistics, fit_rules, statistics
from questlake.llm.queries import QUERIES
from questlake.llm.registry import SQL
from questlake.llm.resample import resample
from tests.llm.conftest import ROWS


# ---- resampling

def _features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def plain_resample(docs, target, least, percent):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % 10_000 for t in texts for f in _features(t)[1])
    s, t = count([x for _, x in docs]), count(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))
    rows = []
    for doc, text in docs:
        words, found = _features(text)
        weight = sum(gain(zlib.crc32(f.encode()) % 10_000) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((*r[:4], rank.get(r[0])) for r in rows)


@pytest.mark.parametrize(("parts", "segment_rows", "percent"), [(1, 1000, 25), (7, 20, 25), (13, 3, 60), (5, 1, 100)])
def test_resampling_ranks_exactly(spark, parts, segment_rows, percent):
    draw = random.Random(parts)
    docs = [(i, " ".join(draw.choices(["Alpha", "beta", "née", "d4", "e"], k=draw.randint(0, 9)))) for i in range(300)]
    target = ["alpha beta alpha", None, "", "née d4"]
    got = resample(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(parts),
        spark.createDataFrame([(t,) for t in target], "text string"),
        least_words=3, percent=percent, segment_rows=segment_rows,
    )
    assert sorted(tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == plain_resample(docs, target, 3, percent)


def test_equal_scores_are_cut_and_ranked_by_id(spark):
    """Rows of one id have one score: a third of the table ties, and is still split over segments."""
    docs = spark.createDataFrame([(i if i % 3 else 0, "same words " * 12) for i in range(300)], "doc_id long, text string").repartition(6)
    got = resample(docs, docs.select("text"), percent=100, segment_rows=10).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 301))
    ties = [r["rank"] for r in got if r.doc_id == 0]
    assert max(ties) - min(ties) == 99


def test_resampling_edges(edge, nothing, spark):
    target = edge.select("text")
    got = resample(edge, target, least_words=3, percent=100).collect()
    assert len(got) == len(ROWS)
    able = [r for r in got if r.n_words >= 3]
    assert sorted(r["rank"] for r in able) == list(range(1, len(able) + 1))
    assert all((r.n_features, r.weight, r["rank"]) == (0, 0, None) for r in got if not r.n_words)
    assert [r.n_features for r in got if r.doc_id == 8] == [59_999]
    assert resample(nothing, target).collect() == []
    assert len(resample(edge, nothing).collect()) == len(ROWS)
    again = resample(edge.repartition(5), target, least_words=3, percent=100).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(key, got)) == sorted(map(key, again))


# ---- phrases

def plain_counts(docs, longest=4):
    counts, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang, " ".join(words[i : i + n])) for i in range(len(words) - n + 1))
    return counts, total


def random_docs(seed, n=400):
    draw = random.Random(seed)
    words = ["the", "The", "of", "a", "a\x00b", "a\x01", "é", "ÉTÉ", "x\xff", "new", "york", "#", "city"]
    ends = [" ", " ", " ", " ", "\t", "  ", ", ", ". ", "\n", "\x0b", "!"]
    text = lambda: "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randint(0, 60)))
    return [(draw.choice(["en", "en", "de", "", None]), draw.choice([None, "", text(), text(), text()])) for _ in range(n)]


SMALL = {"full": 50, "slice_bytes": 900, "split_windows": 60}


@pytest.mark.parametrize(("limits", "burst", "words"), [({}, 8192, 1 << 20), (SMALL, 4, 1 << 20), ({"full": 200, "split_windows": 3}, 8, 6)])
def test_phrase_counts(spark, monkeypatch, limits, burst, words):
    """Also with containers that burst, tries that spill, vocabularies that start anew and slices split to the end."""
    monkeypatch.setattr(phrases, "BURST", burst)
    monkeypatch.setattr(phrases, "MOST_WORDS", words)
    monkeypatch.setattr(phrases, "_BATCH", 100)
    monkeypatch.setattr(phrases, "_CHUNK", 64)
    docs = random_docs(burst)
    counts, total = plain_counts(docs)
    assert _local(docs, limits.get("full", phrases.FULL)) == sum(total.values())
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    found, words_of = phrase_counts(frame, least=5, **limits)
    assert {(r.lang, r.phrase): r.n for r in found.collect()} == {k: n for k, n in counts.items() if n >= 5}
    assert {r.lang: r.n for r in words_of.collect()} == {k: n for k, n in total.items() if n}


def _local(docs, full):
    """The words counted in the runs that one task leaves, which must be sorted."""
    task = phrases._Task(4, full, 3)
    n = 0
    batches = [batch for lang, text in docs for batch in task.read(lang or "und", (text or "").encode())]
    for batch in [*batches, *task.count(), *task.finish()]:
        n += sum(batch.column("words").to_pylist())
        for run in batch.column("run").to_pylist():
            heads, sizes, times, rest = phrases._unpacked(run)
            heads, rests = heads.split(b"\n")[:-1], iter(rest.split(b"\n"))
            assert heads == sorted(set(heads)) and len(times) == sizes.sum()
            for size in sizes.tolist():
                of_head = [next(rests) for _ in range(size)]
                assert of_head == sorted(set(of_head))
    return n


def test_trie_bursts_and_counts(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 3)
    rng = np.random.default_rng(3)
    windows = np.stack([rng.integers(1, 900, 3000), rng.integers(1, 3, 3000), rng.integers(0, 4, 3000), rng.integers(0, 2, 3000)], axis=1)
    windows[:1500, 0] = 7
    trie = HatTrie()
    new = sum(trie.add(part) for part in np.array_split(windows, 30))
    got = Counter()
    for container in trie.containers():
        for window, n in zip(phrases._windows(list(container)).tolist(), container.values(), strict=True):
            got[tuple(window)] += n
    assert got == Counter(map(tuple, windows.tolist())) and new == len(got)
    below = [c for c in trie.children.values() if isinstance(c, HatTrie)]
    assert below and any(isinstance(c, HatTrie) for node in below for c in node.children.values())


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_collocations_equal_sql(spark, limits):
    docs = random_docs(7, 900)
    table = pa.table({"doc_id": range(len(docs)), "lang": [a for a, _ in docs], "text": pa.array([b for _, b in docs], pa.string())})
    con = duckdb.connect()
    con.register("documents", table)
    got = collocations(spark.createDataFrame(docs, "lang string, text string").repartition(4), **limits)
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(SQL["op12_phrases"]).fetchall())
    assert got.count() > 20


def test_large_counts_stay_exact(spark):
    """Two million times a count passes 64 bits: the score divides decimals in whole numbers."""
    a = 9_007_199_254_740_993
    frame = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l1 long, r1 long")
    score = frame.select(F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l1 as decimal(20,0)) + cast(r1 as decimal(20,0)))"))
    assert score.first()[0] == 2_000_000 * a // (2 * a + 3)


def test_phrase_edges(edge, nothing):
    counts, total = plain_counts([(r[2], r[1]) for r in ROWS])
    found, words = phrase_counts(edge, least=2)
    assert {(r.lang, r.phrase): r.n for r in found.collect()} == {k: n for k, n in counts.items() if n >= 2}
    assert {r.lang: r.n for r in words.collect()} == {k: n for k, n in total.items() if n}
    assert [tuple(r)[:4] for r in collocations(edge).collect()] == [("en", 1, "word word word word", 29_997)]
    assert collocations(nothing).collect() == []


# ---- quality rules

def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_statistics():
    draw = random.Random(5)
    pieces = ["one", "two ", "é#", "|", "\n", " \n", "\tx", "same line\n", "same line\n", "日本", "\x0b", "A!!", ""]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 40))) for _ in range(400)] + [None, "", " \n ", "w " * 5000, "x" * 70_000]
    column = pa.array(texts, pa.string())
    counts, features = statistics(column)
    assert [tuple(c) for c in counts.tolist()] == [plain_statistics(t) for t in texts]
    assert features.shape == (len(texts), len(FEATURES)) and np.isfinite(features).all()
    some = column.slice(7, 50)
    assert (statistics(some)[0] == counts[7:57]).all() and np.allclose(statistics(some)[1], features[7:57])
    assert statistics(pa.array([], pa.string()))[0].shape == (0, 5)


def _walk(forest, x):
    """Down each tree one node after the other."""
    total = forest.base
    for at in forest.roots.tolist():
        while forest.left[at] != at:
            at = int(forest.left[at] if x[forest.feature[at]] <= forest.threshold[at] else forest.right[at])
        total += forest.value[at]
    return 1 / (1 + math.exp(-total))


def test_forest_learns_and_is_monotonic():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 1) ^ (rng.random(1500) < 0.1)).astype(float)
    forest = boost(x, y, [0, -1, 1], trees=30)
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.75
    assert forest.score(x[:50]) == pytest.approx([_walk(forest, row) for row in x[:50]])
    for feature, sign in ((1, -1), (2, 1)):
        grid = np.repeat(x[:100], 60, axis=0)
        grid[:, feature] = np.tile(np.linspace(-4, 4, 60), 100)
        steps = np.diff(forest.score(grid).reshape(100, 60), axis=1)
        assert (sign * steps >= -1e-12).all()
    free = boost(x, y, [0, 0, 0], trees=30)
    grid[:, 1] = np.tile(np.linspace(-4, 4, 60), 100)
    assert (np.diff(free.score(grid).reshape(100, 60), axis=1) > 1e-6).any()
    one_class = boost(x, np.ones(1500), [0, 0, 0])
    assert (one_class.score(x) > 0.99).all() and len(one_class.roots) == 0


def test_rules_edges(edge, nothing, spark):
    labels = spark.createDataFrame([(1, 1, 0), (8, 0, 0), (None, 1, 0), (3, None, 1), (3, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")
    forest = fit_rules(edge, labels)
    got = apply_rules(edge, forest).collect()
    want = sorted(plain_statistics(r[1]) for r in ROWS)
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed and not r.kept for r in got)  # short, or the long one that repeats one word
    assert apply_rules(nothing, forest).collect() == []
    for empty in (fit_rules(nothing, labels), fit_rules(edge, labels.where("false"))):
        assert len(empty.roots) == 0 and len(apply_rules(edge, empty).collect()) == len(ROWS)
    assert document_statistics(edge).count() == len(ROWS)


def test_rules_hold_on_rows_not_learned_from(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op13_quality_rules"](spark, sf).collect()}
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    assert got.keys() == texts.keys()
    for doc, r in got.items():
        counts = plain_statistics(texts[doc])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert r.kept == (not r.base_failed and r.score >= 0.5)
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    unseen = [(got[d], q) for d, q in labels if zlib.crc32(str(d).encode()) % 3 == 1 and not got[d].base_failed]
    assert sum(r.kept == (q == 1) for r, q in unseen) >= 0.97 * len(unseen)
    assert quality_rules.FIT_ROWS == 20_000
