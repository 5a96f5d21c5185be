"""Nulls in any column, empty and long texts, ties and repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from questlake.llm.decontaminate import contamination
from questlake.llm.exact_dedup import exact_dedup
from questlake.llm.jaccard_join import near_duplicates
from questlake.llm.license_scan import TEMPLATES, scan_licenses
from questlake.llm.mixing import mix
from questlake.llm.pii import find_personal_data
from questlake.llm.quality import fit_quality, score_quality
from questlake.llm.sharding import read_shards, shuffle_to_files
from questlake.llm.substring_dedup import remove_repeats
from questlake.llm.url_filter import judge_captures
from tests.llm.conftest import ROWS


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "quick brown fox"), (1, "brown fox jumps"), (2, None), (3, ""), (None, "me example org"), (4, " ".join(["word"] * 13))]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (8, 0, 0), (None, 1, 0), (3, None, 1), (3, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int")


def test_decontamination(edge, nothing, items):
    got = contamination(edge, items, clean=True, records=True).collect()
    assert len(got) == len(ROWS)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[1].items == ["1"] and by_id[1].n_hit == 4 and by_id[1].contaminated
    assert by_id[1].clean_text.startswith("the  over the lazy dog")
    assert by_id[7].items == [""] and by_id[7].n_hit == 3
    assert by_id[8].n_hit == 30_000 and by_id[8].spans == [[0, 30_000]] and by_id[8].clean_text == " "
    assert (by_id[4].n_words, by_id[4].n_hit, by_id[4].contaminated) == (0, 0, False)
    assert contamination(nothing, items).collect() == []
    assert all(not r.contaminated for r in contamination(edge, items.where("false")).collect())


def test_blocks_of_a_large_benchmark_find_the_same(edge, items):
    whole, blocks = (contamination(edge, items, window=3, block_words=b).drop("spans").collect() for b in (1000, 4))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words)
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, blocks), key=str) and key


def test_exact_dedup(edge, nothing):
    got = exact_dedup(edge, nodes=5, fan_in=2).collect()
    assert len(got) == len(ROWS)
    same = [r for r in got if r.group_size == 4]
    assert len(same) == 0  # case differs in one of them
    same = [r for r in got if r.group_size == 3]
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in same if r.doc_id in (1, 2)) == [(1, 1, True), (2, 1, False), (2, 1, False)]
    empty = [r for r in got if r.doc_id in (4, 5) or r.doc_id is None and r.keep_id == 4]
    assert {r.keep_id for r in empty} == {4} and sum(r.kept for r in empty) == 1
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})
    assert exact_dedup(nothing).collect() == []


def test_substring_dedup(edge, nothing):
    got = remove_repeats(edge).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(ROWS) and by_id[1].n_removed == 0 and by_id[8].n_removed == 0
    assert (by_id[2].n_removed, by_id[2].kept_text) == (16, "")
    assert (by_id[3].n_removed, by_id[3].kept_text) == (15, "The")
    assert all(by_id[i].n_words == 0 for i in (4, 5, 6))
    assert remove_repeats(nothing).collect() == []


def test_near_duplicates(edge, nothing):
    got = near_duplicates(edge).collect()
    assert len(got) == len(ROWS)
    assert {r.component_id for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert sum(r.kept for r in got if r.doc_id in (1, 2, 3)) == 1
    assert all(r.n_shingles == 0 and r.kept and r.component_id == r.doc_id for r in got if r.doc_id in (4, 5, 6))
    assert [r.n_shingles for r in got if r.doc_id == 8] == [1]
    assert near_duplicates(nothing).collect() == []


def test_quality(edge, nothing, labels):
    got = score_quality(edge, fit_quality(edge, labels), into="new_score").collect()
    assert len(got) == len(ROWS) and all(0 <= r.new_score <= 1 and r.quality_score == "z" for r in got)
    for some in (labels.where("false"), labels.where("quality = 1")):
        assert len(score_quality(edge, fit_quality(edge, some), into="s").collect()) == len(ROWS)
    assert score_quality(nothing, fit_quality(nothing, labels)).collect() == []


def test_mix(edge, nothing):
    got = mix(edge).collect()
    assert len(got) == len(ROWS) and all(0 <= r.copies <= 2 for r in got)
    assert sorted({r.source or "~" for r in got}) == ["a", "b", "c", "~"] or "" in {r.source for r in got}
    assert {r.target for r in got if r.source == "b"} == {0.0}
    assert mix(nothing).collect() == []


def test_shards(spark, edge, nothing, tmp_path):
    for name, df, n in (("edge", edge, len(ROWS)), ("none", nothing, 0)):
        shuffle_to_files(df, f"{tmp_path}/{name}", bucket_bytes=64)
        got = read_shards(spark, f"{tmp_path}/{name}", 5).collect()
        assert len(got) == n
        for shard in {r.shard for r in got}:
            slots = sorted(r.slot for r in got if r.shard == shard)
            assert slots == list(range(len(slots))) and len(slots) in (n // 5, n // 5 + 1)


def test_repeated_rows_are_scattered(spark, tmp_path):
    df = spark.range(4000).selectExpr("1L AS doc_id", "'same' AS text")
    shuffle_to_files(df, f"{tmp_path}/x", bucket_bytes=1000)
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/x").groupBy("shard_bucket").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2.5 * 4000 / 20


def test_urls(spark):
    rows = [
        (1, "https://A.b.example.org:80/x/y?q=1", "2024-01-05"), (2, "http://b.example.org/", "2024-01-01"), (2, "http://b.example.org/", "2024-01-01"),
        (3, None, "2024-01-05"), (4, "not a url", "2024-01-05"), (None, "http://example.org/x", "2024-01-12"), (5, "http://example.org", None),
    ]
    captures = spark.createDataFrame(rows, "page_id long, url string, at string").withColumn("fetched", F.to_date("at"))
    lists = [
        ("l", "example.org", "2024-01-02", True), ("l", "example.org", "2024-01-10", False), ("m", "a.b.example.org/x", "2024-01-05", True),
        ("l", "example.org", "2024-01-03", True), ("m", None, "2024-01-01", True), ("m", "b.example.org", None, True), ("m", "org", "2024-01-01", False),
    ]
    entries = spark.createDataFrame(lists, "list string, key string, day string, listed boolean").withColumn("since", F.to_date("day"))
    got = sorted(((r.capture_id or 0, r.n_entries, r.lists, r.blocked) for r in judge_captures(captures, entries).collect()))
    assert got == [(0, 0, [], False), (1, 2, ["l", "m"], True), (2, 0, [], False), (2, 0, [], False), (3, 0, [], False), (4, 0, [], False), (5, 0, [], False)]
    assert judge_captures(captures.where("false"), entries).collect() == []
    assert not any(r.blocked for r in judge_captures(captures, entries.where("false")).collect())


def test_licenses(spark):
    rows = [
        (1, "p/LICENSE", "Released under the MIT License."), (2, "p/a/b.c", "int main"), (3, "p/a/c.c", "x\nLicensed under CC BY-NC 4.0.\ny"),
        (4, "p/a/LICENSE", "nothing said"), (5, "q/x.c", None), (6, None, ""), (7, "p/q/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        (8, "p/q/r/s.c", ""), (8, "p/q/r/s.c", ""), (9, "top.c", "license"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    templates = spark.createDataFrame(TEMPLATES, "license string, template string")
    got = {(r.file_id, r.own, r.license, r.inherited_from) for r in scan_licenses(files, templates).collect()}
    assert {g for g in got if g[0] != 9} == {
        (1, "MIT", "MIT", None), (2, None, "MIT", "p"), (3, "CC-BY-NC-4.0", "CC-BY-NC-4.0", None), (4, None, "MIT", "p"), (5, None, None, None),
        (6, None, None, None), (7, "GPL-3.0", "GPL-3.0", None), (8, None, "GPL-3.0", "p/q"),
    }
    assert scan_licenses(files.where("false"), templates).collect() == []


def test_personal_data(spark, edge, nothing):
    got = find_personal_data(edge).collect()
    assert len(got) == len(ROWS)
    assert [[tuple(s) for s in r.spans] for r in got if r.doc_id == 7] == [[(0, 5, 19), (3, 28, 45)]]
    assert sum(len(r.spans) for r in got) == 2
    long = spark.createDataFrame([(1, "1 " * 100_000), (2, "a" * 200_000), (3, "7" * 200_000), (4, "+1" + "(" * 100_000)], "doc_id long, text string")
    assert sum(len(r.spans) for r in find_personal_data(long).collect()) == 0
    assert find_personal_data(nothing).collect() == []


def test_pipeline_stages(spark, edge, nothing, tmp_path, items, labels):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = edge.drop("shard", "slot").withColumn("decision_id", F.lit("d"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns
        assert stage(spark, nothing, str(tmp_path)).collect() == [], name
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert [r.doc_id for r in kept if r.doc_id in (1, 2, 3)] == [1] and len(kept) == len(ROWS) - 3
    assert len(corpus_pipeline.sharding(spark, docs, "").collect()) == len(ROWS)
