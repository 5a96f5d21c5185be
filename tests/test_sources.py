import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from questlake import session
from questlake.plans.reports import json_rows, report
from questlake.sources import hdfs, models
from questlake.sources.jsonl import preview, read_raw, read_rejects, write_bronze
from questlake.sources.pages import page_results
from questlake.sources.retention import drop_expired
from questlake.sources.snapshots import merge_buckets, publish, read_published
from questlake.streaming.incremental import load_new_files, read_raw_table, read_rejected


def texts(df, column="raw_data"):
    return sorted(r[0] for r in df.select(F.to_json(column)).collect())


def test_malformed_line_is_skipped_and_reported(spark, tmp_path):
    (tmp_path / "data.jsonl").write_text('{"id": 1}\n{bad\n\n{"id": 2, "name": null}\n', encoding="utf-8")
    raw = read_raw(spark, str(tmp_path), dt.datetime(2026, 1, 5))
    assert texts(raw) == ['{"id":1}', '{"id":2,"name":null}']
    assert {r.loaded_at for r in raw.collect()} == {dt.datetime(2026, 1, 5)}
    assert [r.value for r in read_rejects(spark, str(tmp_path)).collect()] == ["{bad"]


def test_plain_date_folders(spark, tmp_path):
    for day, line in (("2026-06-13", '{"id":1}'), ("2026-06-20", '{"id":2}')):
        (tmp_path / "games" / day).mkdir(parents=True)
        (tmp_path / "games" / day / "data.jsonl").write_text(line + "\n")
    rows = read_raw(spark, f"{tmp_path}/games", dated=True)
    assert {str(r.ingest_date) for r in rows.collect()} == {"2026-06-13", "2026-06-20"}
    assert texts(read_raw(spark, f"{tmp_path}/games/2026-06-20", dated=True)) == ['{"id":2}']


def test_bronze_replaces_its_date_only(spark, docs, tmp_path):
    base = str(tmp_path)
    day = lambda text: F.lit(text).cast("date")
    write_bronze(docs('{"id":1,"name":"Hadès"}', '{"id":2,"n":null}').withColumn("ingest_date", day("2026-06-13")), base, "games")
    write_bronze(docs('{"id":3}').withColumn("ingest_date", day("2026-06-20")), base, "games")
    write_bronze(docs('{"id":4}').withColumn("ingest_date", day("2026-06-20")), base, "games", compact=True)
    write_bronze(docs('{"id":5}').where("false").withColumn("ingest_date", day("2026-06-20")), base, "games")
    assert sorted(p.name for p in (tmp_path / "games").glob("ingest_date=*")) == ["ingest_date=2026-06-13", "ingest_date=2026-06-20"]
    assert texts(read_raw(spark, f"{base}/games")) == ['{"id":1,"name":"Hadès"}', '{"id":2,"n":null}', '{"id":4}']
    one_day = read_raw(spark, f"{base}/games").where("ingest_date = date '2026-06-13'")
    assert one_day.count() == 2


def test_each_file_is_loaded_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "ckpt"))
    assert load_new_files(spark, source, target, checkpoint) == (0, 0)
    assert read_raw_table(spark, target).count() == 0
    day = tmp_path / "in" / "2026-06-13"
    day.mkdir(parents=True)
    (day / "data.jsonl").write_text('{"id": 1}\n{bad\n')
    assert load_new_files(spark, source, target, checkpoint) == (1, 1)
    assert load_new_files(spark, source, target, checkpoint) == (0, 0)
    (day / "more.jsonl").write_text('{"id": 2}\n')
    assert load_new_files(spark, source, target, checkpoint, dt.datetime(2026, 6, 20)) == (1, 0)
    assert [r.value for r in read_rejected(spark, target).collect()] == ["{bad"]
    rows = read_raw_table(spark, target)
    assert texts(rows) == ['{"id":1}', '{"id":2}']
    assert rows.where("loaded_at = timestamp '2026-06-20'").count() == 1


def test_pages(spark, docs):
    pages = docs(
        '{"results": [{"id": 1, "name": "A"}, {"id": 2, "name": "B"}], "next": "u"}',
        '{"results": [{"id": 3, "name": "C"}], "next": null}',
        '{"results": []}',
        '{"next": null}',
    )
    assert texts(page_results(pages)) == ['{"id":1,"name":"A"}', '{"id":2,"name":"B"}', '{"id":3,"name":"C"}']


def test_preview(docs):
    raw = docs(
        '{"id": 1, "name": "N", "released": "2026-06-17", "rating": 4.5, "metacritic": null,'
        ' "genres": [{"name": "A"}, null], "platforms": [{"platform": null}, {"platform": {"name": "PC"}}, null]}',
        '{"id": 2}',
        '{"id": 3}',
    )
    got = {r.id: r.asDict() for r in preview(raw.coalesce(1)).collect()}
    assert len(got) == 2
    assert got[1]["genres"] == ["A"] and got[1]["platforms"] == ["PC"] and got[1]["metacritic"] is None
    assert got[2]["genres"] == [] and got[2]["platforms"] == [] and got[2]["name"] is None


def test_publish_switches_versions(spark, tmp_path):
    base = str(tmp_path)
    assert publish(spark.range(3).withColumn("x", F.lit(1)), base, "t", ["x", "id"]) == 3
    first = read_published(spark, base, "t")
    assert first.columns == ["x", "id"]
    assert publish(first.where("id > 0"), base, "t", ["x", "id"]) == 2
    assert read_published(spark, base, "t").count() == 2
    assert first.count() == 3
    assert publish(spark.range(0).withColumn("x", F.lit(1)), base, "t", ["x", "id"]) == 0
    assert read_published(spark, base, "t").count() == 0
    assert len([f for f in hdfs.child_folders(spark, f"{base}/t") if f.startswith("v-")]) == 2


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("name"), F.lit(1.5).alias("v"))
    merge_buckets(rows, path, "k", ["name"], buckets=8)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    changes = spark.createDataFrame([(5, "b"), (1000, "new")], "k long, name string")
    merge_buckets(changes, path, "k", ["name"], buckets=8)
    got = {r.k: (r.name, r.v) for r in spark.read.parquet(path).collect()}
    assert len(got) == 201 and got[5] == ("b", 1.5) and got[1000] == ("new", None) and got[6] == ("a", 1.5)
    kept = [p for p in before if p.exists()]
    assert len(kept) >= 6
    merge_buckets(changes.where("false"), path, "k", ["name"], buckets=8)
    with pytest.raises(Exception, match="k must not be null"):
        merge_buckets(spark.createDataFrame([(None, "x")], "k long, name string"), path, "k", ["name"], buckets=8)


def test_retention(spark, tmp_path):
    for name in ("ingest_date=2026-05-20", "ingest_date=2026-05-21", "ingest_date=2026-06-20", "other", "ingest_date=x"):
        (tmp_path / name).mkdir()
    assert drop_expired(spark, str(tmp_path), dt.date(2026, 6, 20)) == ["ingest_date=2026-05-20"]
    assert not (tmp_path / "ingest_date=2026-05-20").exists() and (tmp_path / "other").exists()


def test_named_models(spark, tmp_path):
    models.as_view(spark.range(2), "v_two")
    assert spark.sql("SELECT count(*) FROM v_two").first()[0] == 2
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts_test LOCATION '{tmp_path}'")
    models.as_table(spark.range(2), "marts_test.t")
    assert models.as_table(spark.range(3), "marts_test.t").count() == 3
    spark.sql("DROP DATABASE marts_test CASCADE")


def test_json_rows(spark):
    df = spark.sql("SELECT date '2026-06-17' AS Day, cast(1.50 AS decimal(5,2)) AS d, cast(NULL AS int) AS n, 4.0D AS x, timestamp_ntz '2026-06-17 01:02:03' AS t")
    assert json.loads(json_rows(df).first().json) == {"day": "2026-06-17", "d": "1.50", "n": None, "x": 4.0, "t": "2026-06-17 01:02:03"}


def test_unknown_report_lists_names():
    with pytest.raises(ValueError, match="daily_release_counts, genre_trends, game_count, top_games"):
        report(lambda name: None, "nope")


def test_shared_dir_comes_from_the_session(spark, monkeypatch):
    class Conf:
        def get(self, name, default):
            return {"spark.checkpoint.dir": "hdfs://shared/dir/"}.get(name, default)

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "yarn"

        conf = Conf()

    assert session.shared_dir(Cluster()) == "hdfs://shared/dir"
    monkeypatch.setattr(Conf, "get", lambda self, name, default: default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())
