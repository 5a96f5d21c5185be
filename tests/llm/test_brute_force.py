"""Operators against slow and plain versions of themselves, on small random texts."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa

import corpus_pipeline
from questlake.llm import jaccard_join, mixing
from questlake.llm.decontaminate import SuffixAutomaton
from questlake.llm.exact_dedup import exact_dedup
from questlake.llm.fm_index import FMIndex, WaveletTree, first_owners
from questlake.llm.jaccard_join import fingerprint, least_different, near_duplicates, signatures, tagged
from questlake.llm.mixing import mix
from questlake.llm.queries import QUERIES
from questlake.llm.shingles import words_of
from questlake.llm.substring_dedup import remove_repeats


def texts_with_copies(seed, n, words=60, length=(1, 90)):
    """Random texts, near copies of some at all distances, and lines that many share."""
    draw = random.Random(seed)
    line = " ".join(f"line{i}" for i in range(14))
    texts = []
    for _ in range(n):
        if texts and draw.random() < 0.5:
            text = draw.choice(texts[:20]).split()
            for _ in range(draw.randint(0, 6)):
                if text:
                    text[draw.randrange(len(text))] = f"w{draw.randrange(words)}"
        else:
            text = [f"w{draw.randrange(words)}" for _ in range(draw.randint(*length))]
        if draw.random() < 0.3:
            text = text + line.split()
        texts.append(" ".join(text))
    return texts


def test_words_and_places():
    texts = ["  One two\tthree ", "", None, "É é\x0bx", "last"]
    column = pa.array(texts)[0:]
    (words,) = words_of(column, lower=True)
    plain = [(t or "").encode().lower().split() for t in texts]
    assert np.diff(words.first).tolist() == [len(p) for p in plain]
    assert [words.text[a:b] for a, b in zip(words.starts, words.ends, strict=True)] == [w for p in plain for w in p]
    flat = [w for p in plain for w in p]
    assert len(set(words.hashes.tolist())) == len(set(flat))
    assert [len(list(words_of(column.slice(i)))[0].hashes) for i in range(5)] == [sum(map(len, plain[i:])) for i in range(5)]


def test_wavelet_tree_counts():
    rng = np.random.default_rng(1)
    sequence = rng.integers(0, 11, 700)
    tree = WaveletTree(sequence, 11)
    symbols, at = rng.integers(0, 11, 500), rng.integers(0, 701, 500)
    assert tree.rank(symbols, at).tolist() == [int((sequence[:a] == s).sum()) for s, a in zip(symbols, at, strict=True)]


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 4, rng.integers(5, 60)) for _ in range(20)]
    index = FMIndex(texts, 4, 5)
    flat = index.sequence
    starts = np.array([i for i in range(len(flat) - 5) if 0 not in flat[i : i + 5]])
    low, high = index.search(starts, 5)
    for s, a, b in zip(starts, low, high, strict=True):
        same = [i for i in range(len(flat) - 4) if (flat[i : i + 5] == flat[s : s + 5]).all()]
        assert sorted(index.suffixes[a:b].tolist()) == same


def test_first_owners():
    draw = random.Random(3)
    texts = [[b"%d" % draw.randrange(3) for _ in range(draw.randint(4, 30))] for _ in range(30)]
    owners = [draw.randrange(100) for _ in texts]
    least = defaultdict(lambda: 1000)
    for text, owner in zip(texts, owners, strict=True):
        for i in range(len(text) - 3):
            run = tuple(text[i : i + 4])
            least[run] = min(least[run], owner)
    got = first_owners(texts, np.array(owners), 4)
    assert [g.tolist() for g in got] == [[least[tuple(t[i : i + 4])] for i in range(len(t) - 3)] for t in texts]


def test_suffix_automaton():
    draw = random.Random(4)
    items = [(str(k), [b"%d" % draw.randrange(3) for _ in range(draw.randint(1, 12))]) for k in range(12)]
    automaton = SuffixAutomaton(items, 5)
    for _ in range(60):
        words = [b"%d" % draw.randrange(4) for _ in range(40)]
        hit, found = set(), set()
        for name, item in items:
            n = min(5, len(item))
            for i in range(len(item) - n + 1):
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == item[i : i + n]:
                        hit |= set(range(p, p + n))
                        found.add(name)
        spans, ids = automaton.matches(words)
        assert ({p for a, b in spans for p in range(a, b)}, ids) == (hit, found)


def test_exact_dedup(spark):
    texts = texts_with_copies(5, 200, words=2, length=(1, 4))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    first, count = {}, defaultdict(int)
    for i, t in enumerate(texts):
        first.setdefault(t, i)
        count[t] += 1
    for nodes, fan in ((1, 2), (7, 2), (9, 3), (4, 8)):
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(df, nodes=nodes, fan_in=fan).collect()}
        assert got == {i: (first[t], count[t], first[t] == i) for i, t in enumerate(texts)}


def test_substring_dedup(spark):
    texts = texts_with_copies(6, 150)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    first = {}
    for i, t in enumerate(texts):
        w = t.split()
        for p in range(len(w) - 6):
            first.setdefault(tuple(w[p : p + 7]), i)
    want = {}
    for i, t in enumerate(texts):
        w, gone = t.split(), set()
        for p in range(len(w) - 6):
            if first[tuple(w[p : p + 7])] < i:
                gone |= set(range(p, p + 7))
        want[i] = (len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    for index_words in (100_000, 50):
        got = remove_repeats(df, window=7, anchor=3, index_words=index_words).collect()
        assert {r.doc_id: (r.n_removed, r.kept_text) for r in got} == want


def _shingles(text, size=3):
    w = text.lower().split()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def _components(sets, percent):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(sets))]


def test_near_duplicates(spark, monkeypatch):
    # A low bound of frequency and long texts, so that pairs of frequent shingles sign too.
    monkeypatch.setattr(jaccard_join, "_LEAST_FREQUENT", 3)
    draw = random.Random(7)
    base = [f"b{i}" for i in range(150)]
    texts = texts_with_copies(8, 160, words=400, length=(1, 120))
    for _ in range(60):
        copy = list(base)
        for _ in range(draw.randint(0, 5)):
            copy[draw.randrange(len(copy))] = f"e{draw.randrange(10_000)}"
        texts.append(" ".join(copy))
    sets = [_shingles(t) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    for percent in (90, 80):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, percent=percent).collect()}
        assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(sets, _components(sets, percent), strict=True))}


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(9)
    frequent = np.sort(rng.integers(0, 1 << 63, 2000, dtype=np.uint64))
    heavy = np.sort(np.concatenate([tagged(frequent, bits) for bits in range(12)]))
    for trial in range(300):
        n = int(rng.integers(10, 400))
        pool = np.unique(np.r_[rng.choice(frequent, int(n * rng.random())), rng.integers(0, 1 << 63, n, dtype=np.uint64)])[: n + 40]
        a = np.sort(pool[:n])
        shared = -(-9 * n // 10)
        b = np.sort(np.r_[rng.permutation(a)[:shared], rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 20))), dtype=np.uint64)])
        both = len(np.intersect1d(a, b))
        for bits in ((8, 8), (8, 10), (len(a).bit_length(), len(b).bit_length())):
            assert least_different(fingerprint(a, max(3, bits[0])), fingerprint(b, max(3, bits[1]))) <= len(a) + len(b) - 2 * both
        if 100 * both >= 90 * (len(a) + len(b) - both):
            (x, px), (y, py) = signatures(a, heavy), signatures(b, heavy)
            common, i, j = np.intersect1d(x, y, return_indices=True)
            assert len(common) and (np.minimum(len(a) - px[i], len(b) - py[j]).max() >= both)


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        luhn = sum((2 * d - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(digits))))
        return 16 <= len(digits) <= 19 and luhn % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_personal_data(spark, tmp_path):
    draw = random.Random(10)
    parts = ["a", "b.c", "@", "x@y.z", "é", "1", "25", "256", ".", " ", "-", "+", "(", ")", "4111111111111111", "\n", "%", "+1 (555) 123-4567", "1.2.3.4"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(400)]
    texts += [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op10_pii"](spark, str(tmp_path)).collect()}
    for i, text in rows:
        spans = [(k, m.start(), m.end()) for k in FORMS for m in re.finditer(FORMS[k], text) if _valid(k, m.group())]
        told = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert got[i].base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest(), text
        assert got[i].spans.split(",")[: len(told)] == told or not told
        assert [got[i][f"n_{k}"] for k in FORMS] == [sum(s[0] == k for s in spans) for k in FORMS]


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    """Each stage on what the stage before kept, against its contract."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs.collect()
    texts = {r.doc_id: r.text for r in kept["quality"]}
    ids = sorted(texts)
    component = _components([_shingles(texts[i], corpus_pipeline.NEAR_SIZE) for i in ids], corpus_pipeline.NEAR_PERCENT)
    assert {r.doc_id for r in kept["near_dedup"]} == {ids[c] for c in component} and len(kept["near_dedup"]) == len(set(component))
    dirty = {r.doc_id for r in QUERIES["op1_decontaminate"](spark, sf).collect() if r.contaminated}
    assert {r.doc_id for r in kept["decontaminate"]} == {r.doc_id for r in kept["near_dedup"]} - dirty
    sizes = {r.doc_id: len(r.text.encode().split()) for r in kept["decontaminate"]}
    mixed = sum(sizes[r.doc_id] for r in kept["mixing"])
    assert abs(mixed - 1.5 * sum(sizes.values())) < 0.02 * mixed
    assert sorted(r.doc_id for r in kept["sharding"]) == sorted(r.doc_id for r in kept["mixing"])
    assert {r.shard for r in kept["sharding"]} == set(range(8))


def _mix_table(spark, seed, n=600):
    draw = random.Random(seed)
    rows = [(i, " ".join(["w"] * draw.choice([0, 1, 3, 10, 40, draw.randint(1, 3000)])), draw.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixing_rates(spark):
    """The rates against halving a bracket for each source's multiplier."""
    rows, frame = _mix_table(spark, 4)
    got = {r.doc_id: r for r in mix(frame).collect()}
    sizes = {i: len(t.split()) for i, t, _ in rows}
    for source in ("a", "b", "c", None):
        ids = [i for i, _, s in rows if s == source]
        target, total = got[ids[0]].target, sum(sizes[i] for i in ids)
        mean = max(total / len(ids), 1e-9)
        if target >= 2 * total:
            assert {got[i].rate for i in ids} == {2.0}
            continue

        def rate(i, lam, mean=mean):
            tilt = np.exp(np.clip(lam * sizes[i] / mean, -700, 700))
            return 2 * tilt / (1 + tilt)

        low, high = -700.0, 700.0
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if sum(sizes[i] * rate(i, middle) for i in ids) < target else (low, middle)
        assert np.allclose([got[i].rate for i in ids], [rate(i, low) for i in ids], atol=1e-5)
        taken = sum(sizes[i] * got[i].copies for i in ids)
        assert abs(taken - target) < 0.02 * target


def test_mixing_reruns_agree(spark, monkeypatch):
    """However the rows are partitioned, with slices of a few rows and without merging of partitions."""
    monkeypatch.setattr(mixing, "SLICE_ROWS", 40)
    _, frame = _mix_table(spark, 9)
    settings = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = {s: spark.conf.get(s) for s in settings}
    found = []
    try:
        for coalesce, partitions in (("true", 8), ("false", 3), ("false", 8), ("false", 13), ("false", 13)):
            spark.conf.set(settings[0], coalesce)
            spark.conf.set(settings[1], partitions)
            found.append(sorted((r.doc_id, r.copies) for r in mix(frame.repartition(partitions)).collect()))
    finally:
        for s, value in before.items():
            spark.conf.set(s, value)
    assert all(f == found[0] for f in found) and {c for _, c in found[0]} == {1, 2}
