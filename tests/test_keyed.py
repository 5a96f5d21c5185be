"""The keyed table: merges, commits that die midway, writers that meet, compaction and old versions."""

import random

import pytest
from pyspark.sql import functions as F

from questlake.sources import hdfs, keyed
from questlake.sources.keyed import ConcurrentWrite, compact, manifest, notes, read_keyed, upsert, vacuum


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, name string")


def content(spark, path):
    got = [(r.k, r.name) for r in read_keyed(spark, path).collect()]
    assert len(got) == len(set(got)) == len(dict(got))
    return dict(got)


def files(path):
    return {str(p) for p in path.rglob("*.parquet")}


def test_deltas_are_merged_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("name"), F.lit(1.5).alias("v"))
    assert upsert(table, path, "k", ["name"], buckets=8) == (500, 0)
    before = files(tmp_path)
    assert upsert(rows(spark, (5, "b"), (1000, "new")), path, "k", ["name"]) == (1, 1)
    added = files(tmp_path) - before
    assert before <= files(tmp_path) and len(added) == 1  # few rows, few files, and no other is touched
    got = {r.k: (r.name, r.v) for r in read_keyed(spark, path).collect()}
    assert len(got) == 501 and got[5] == ("b", 1.5) and got[1000] == ("new", None) and got[6] == ("a", 1.5)
    assert upsert(rows(spark, (5, "c")), path, "k", ["name"], {"v": F.lit(2.5)}, notes={"through": 7}) == (0, 1)
    got = {r.k: (r.name, r.v) for r in read_keyed(spark, path).collect()}
    assert got[5] == ("c", 2.5) and len(got) == 501 and notes(spark, path) == {"through": 7}
    assert upsert(rows(spark, (5, "d")).where("false"), path, "k", ["name"]) == (0, 0)
    assert notes(spark, path) == {"through": 7} and content(spark, path)[5] == "c"
    with pytest.raises(Exception, match="k must not be null"):
        upsert(rows(spark, (None, "x")), path, "k", ["name"])
    assert len(content(spark, path)) == 501


def test_random_upserts_equal_a_dict(spark, tmp_path):
    path, draw, want = str(tmp_path / "t"), random.Random(1), {}
    for step in range(9):
        change = {draw.randrange(60): f"{step}" for _ in range(draw.choice([1, 3, 30]))}
        upsert(rows(spark, *change.items()), path, "k", ["name"], buckets=4, most_deltas=3)
        want |= change
        assert content(spark, path) == want
    assert sum(e["kind"] != "base" for e in manifest(spark, path)["live"]) <= 3


def test_a_commit_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert(rows(spark, *[(i, "a") for i in range(50)]), path, "k", ["name"], buckets=4)
    change = rows(spark, (1, "b"), (99, "n"))
    want = content(spark, path)

    def dies(*args):
        raise RuntimeError("killed")

    for module, name in ((hdfs, "create_small"), (keyed, "_write"), (keyed, "_commit")):
        with monkeypatch.context() as patch:
            patch.setattr(module, name, dies)
            with pytest.raises(RuntimeError, match="killed"):
                upsert(change, path, "k", ["name"])
        assert content(spark, path) == want and manifest(spark, path)["version"] == 1
    with monkeypatch.context() as patch:  # the upsert is committed, the compaction after it dies
        patch.setattr(keyed, "compact", dies)
        with pytest.raises(RuntimeError, match="killed"):
            upsert(change, path, "k", ["name"], most_deltas=0)
    assert content(spark, path) == want | {1: "b", 99: "n"}
    upsert(change, path, "k", ["name"], most_deltas=0)
    assert content(spark, path) == want | {1: "b", 99: "n"}
    assert [e["kind"] for e in manifest(spark, path)["live"]].count("update") == 0


def test_of_two_writers_one_begins_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    upsert(rows(spark, (1, "a")), path, "k", ["name"], buckets=2)
    real = keyed._commit

    def other_first(s, p, state):
        monkeypatch.setattr(keyed, "_commit", real)
        upsert(rows(spark, (2, "other")), path, "k", ["name"])
        real(s, p, state)

    monkeypatch.setattr(keyed, "_commit", other_first)
    with pytest.raises(ConcurrentWrite):
        upsert(rows(spark, (3, "late")), path, "k", ["name"])
    assert content(spark, path) == {1: "a", 2: "other"}
    upsert(rows(spark, (3, "late")), path, "k", ["name"])
    assert content(spark, path) == {1: "a", 2: "other", 3: "late"}


def test_compaction_rewrites_touched_buckets_and_vacuum_drops_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(rows(spark, *[(i, "a") for i in range(400)]), path, "k", ["name"], buckets=16)
    first = files(tmp_path)
    upsert(rows(spark, (3, "b"), (1003, "n")), path, "k", ["name"])
    want = content(spark, path)
    assert compact(spark, path) and not compact(spark, path)
    assert content(spark, path) == want and len(want) == 401
    live = manifest(spark, path)["live"]
    assert [e["kind"] for e in live] == ["base", "base"] and 1 <= len(live[0]["without"]) <= 2
    assert vacuum(spark, path, keep=3) == []
    assert len(vacuum(spark, path, keep=1)) == 1 and content(spark, path) == want and first <= files(tmp_path)


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(rows(spark, *[(i, "a") for i in range(400)]), path, "k", ["name"], buckets=4)
    for change in ((3, "b"), (4, "c"), (1003, "n")):
        upsert(rows(spark, change), path, "k", ["name"])
    plan = read_keyed(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
