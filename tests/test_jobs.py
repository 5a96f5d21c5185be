import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from questlake.operators.embed import hashed_words
from questlake.operators.quality import DataQualityError
from questlake.plans import marts, staging
from questlake.plans.embed_sync import embed_query, embeddable, pending_games, search, sync_embeddings
from questlake.plans.jobs import fetched_games, ingest, run_all
from questlake.plans.reports import report
from questlake.sources.jsonl import read_raw
from questlake.sources.snapshots import read_published

END = dt.date(2026, 6, 20)


def game(key, **fields):
    base = {"id": key, "name": f"G{key}", "released": "2026-06-17", "rating": 4.0, "metacritic": 80, "genres": [{"id": 1, "name": "Action"}]}
    return base | fields


def land(folder, entity, *pages):
    (folder / entity).mkdir(parents=True, exist_ok=True)
    lines = "".join(json.dumps(p, ensure_ascii=False) + "\n" for p in pages)
    (folder / entity / "data.jsonl").write_text(lines, encoding="utf-8")


def landing(folder, games, details):
    land(folder, "games", {"results": games[:2], "next": "u"}, {"results": games[2:], "next": None})
    land(folder, "details", *details)
    for entity in ("genres", "platforms"):
        land(folder, entity, {"results": [{"id": 1, "name": "A", "slug": "a", "games_count": 5}], "next": None})
    return str(folder)


# Staging


def staged(docs, *records, **kw):
    raw = docs(*[json.dumps(r) for r in records])
    return staging.stg_games(raw.withColumn("h", F.to_json("raw_data")), ties=[F.asc("h")], **kw)


def test_staging_types_and_keys(docs):
    rows = staged(
        docs, game(1, esrb_rating={"name": "Teen"}, playtime=12.5, released="TBA"), {"id": None, "name": "x"}, {"name": "no key"}
    )
    got = {r.game_id: r for r in rows.collect()}
    assert set(got) == {1, None}
    assert got[1].esrb_rating == "Teen" and got[1].avg_playtime_hours == 13 and got[1].released_date is None
    assert [f.simpleString() for f in rows.schema][:3] == ["game_id:bigint", "name:string", "slug:string"]
    assert len(rows.columns) == 16


def test_bad_number_raises_only_in_the_latest_version(spark, docs):
    old = docs('{"id": 1, "rating": "good"}', loaded_at="2026-06-01 00:00:00")
    new = docs('{"id": 1, "rating": "4.5"}')
    assert staging.stg_games(old.union(new)).first().rating == 4.5
    assert staging.stg_games(old, strict=False).first().rating is None
    with pytest.raises(Exception, match="do not cast: rating"):
        staging.stg_games(old).collect()


def test_null_date_is_ranked_in_the_null_year(docs):
    rows = staged(docs, game(1, released=None), game(2, released=None, rating=5.0), game(3), game(4, metacritic=None))
    got = {r.game_id: r for r in marts.mart_top_games(rows).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[2].overall_rank, got[2].rank_in_year, got[1].rank_in_year, got[3].rank_in_year) == (1, 1, 2, 1)
    assert got[1].overall_rank == 2 and got[3].overall_rank == 3
    assert list(marts.mart_top_games(rows).columns) == marts.COLUMNS["mart_top_games"]


def test_games_without_genres_are_in_no_trend_and_not_embedded(docs):
    rows = staged(
        docs,
        game(1, description_raw="d", genres=[]), game(2, description_raw="d", genres=None), game(3, description_raw="   "),
        game(4, description_raw="d", genres=[None]), game(5, description_raw="d", genres=[{"name": "B"}, {"name": "A"}, {"name": "B"}]),
    )
    assert {r.genre_name: r.game_count for r in marts.mart_genre_trends(rows).collect()} == {"Action": 1, "A": 1, "B": 1}
    assert {r.game_id: r.genres for r in embeddable(rows).collect()} == {4: "", 5: "A, B"}


# Jobs


def test_ingest_validates_and_enriches(spark, tmp_path):
    games = [game(1), game(2, released="2099-01-01"), game(3, released=None), {"name": "no id", "released": "2026-06-14"}]
    details = [{"id": 1, "description_raw": "text", "rating": None}, {"id": 77, "description_raw": "other"}]
    counts = ingest(spark, landing(tmp_path / "in", games, details), str(tmp_path / "bronze"), END)
    assert counts == {"games": 2, "genres": 1, "platforms": 1}
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/bronze/games/ingest_date=2026-06-20").collect()]
    assert sorted(lines, key=str) == sorted(
        [game(1, description_raw="text", rating=None), {"name": "no id", "released": "2026-06-14"}], key=str
    )


def test_ingest_of_nothing_writes_no_partition(spark, tmp_path):
    source = landing(tmp_path / "in", [], [])
    assert ingest(spark, source, str(tmp_path / "bronze"), END)["games"] == 0
    assert not list((tmp_path / "bronze" / "games").glob("ingest_date=*"))


def test_whole_run_twice(spark, tmp_path):
    bronze, out, embed = str(tmp_path / "bronze"), str(tmp_path / "out"), hashed_words()
    first = [game(1), game(2, rating=5.0), game(3, metacritic=None)]
    details = [{"id": i, "description_raw": f"about {i}"} for i in (1, 2)]
    ingest(spark, landing(tmp_path / "in1", first, details), bronze, dt.date(2026, 6, 19))
    result = run_all(spark, bronze, out, embed, dt.datetime(2026, 6, 20, 3))
    assert result["loaded"] == {"games": 3, "genres": 1, "platforms": 1}
    assert result["embedded"] == 2 and result["tests"] == 20
    assert result["published"] == {
        "mart_top_games": 2, "mart_genre_trends": 1, "mart_daily_release_counts": 1, "mart_catalog_stats": 1
    }

    second = [game(1, name="Renamed", rating=1.0), game(4, released="2026-06-20")]
    details = [{"id": i, "description_raw": f"newer {i}"} for i in (1, 4)]
    ingest(spark, landing(tmp_path / "in2", second, details), bronze, END)
    result = run_all(spark, bronze, out, embed, dt.datetime(2026, 6, 27, 3))
    assert result["loaded"]["games"] == 2 and result["embedded"] == 1

    def mart(name):
        return read_published(spark, f"{out}/published", name)

    top = report(mart, "top_games").collect()
    assert [r.name for r in top] == ["G2", "G4", "Renamed"]
    assert report(mart, "game_count").first().total_games == 4
    assert [r.cumulative_release_count for r in report(mart, "daily_release_counts").collect()] == [4, 3]

    store = spark.read.parquet(f"{out}/vectors")
    assert {r.game_id: r.description_raw for r in store.collect()} == {1: "about 1", 2: "about 2", 4: "newer 4"}
    assert search(store, embed_query(spark, "newer 4", embed), 1).first().game_id == 4


def test_failing_test_stops_publish_and_embed(spark, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    nameless = game(1, description_raw="d") | {"name": None}
    ingest(spark, landing(tmp_path / "in", [nameless], []), bronze, END)
    with pytest.raises(DataQualityError, match="stg_games.name not_null: 1"):
        run_all(spark, bronze, out, hashed_words())
    assert not (tmp_path / "out" / "published").exists() and not (tmp_path / "out" / "vectors").exists()


def test_failing_model_leaves_the_publish_done(spark, tmp_path):
    bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
    ingest(spark, landing(tmp_path / "in", [game(1)], [{"id": 1, "description_raw": "d"}]), bronze, END)

    def broken(texts, input_type):
        raise RuntimeError("no model")

    with pytest.raises(Exception, match="no model"):
        run_all(spark, bronze, out, broken)
    assert read_published(spark, f"{out}/published", "mart_catalog_stats").first().total_games == 1
    again = run_all(spark, bronze, out, hashed_words(), buckets=4, retain=(dt.date(2026, 8, 1), 30))
    assert again["embedded"] == 1 and not list((tmp_path / "bronze" / "games").glob("ingest_date=*"))


def test_ingest_reads_the_files_of_its_run(spark, tmp_path):
    for day, text in (("2026-06-13", "old"), ("2026-06-20", "new")):
        for entity, pages in (("games", [{"results": [game(1, name=text)]}]), ("details", [{"id": 1, "description_raw": text}])):
            land(tmp_path / entity, day, *pages)
        for entity in ("genres", "platforms"):
            land(tmp_path / entity, day, {"results": [{"id": 1, "name": text}]})

    def names(entity):
        rows = spark.read.text(f"{tmp_path}/bronze/{entity}/ingest_date=2026-06-20").collect()
        return [(d["name"], d.get("description_raw")) for d in (json.loads(r.value) for r in rows)]

    ingest(spark, str(tmp_path), str(tmp_path / "bronze"), END, run=END)
    assert names("games") == [("new", "new")] and names("genres") == [("new", None)]
    details = read_raw(spark, [f"{tmp_path}/details/2026-06-20", f"{tmp_path}/details/2026-06-13"], dt.datetime(2026, 6, 20))
    pages = read_raw(spark, f"{tmp_path}/games/2026-06-20")
    assert [json.loads(r.raw_data.toJson())["description_raw"] for r in fetched_games(pages, details, END).collect()] == ["new"]


def test_key_that_does_not_cast_is_not_lost(docs):
    raw = docs('{"id": null, "name": "later"}', '{"id": "abc", "name": "x"}', '{"id": "7"}', '{"id": 8.4}', '{"name": "none"}')
    with pytest.raises(Exception, match="game_id abc"):
        staging.stg_games(raw).collect()
    assert {r.game_id for r in staging.stg_games(raw, strict=False).collect()} == {None, 7, 8}
    assert staging.key_rejects(raw, staging.GAMES).count() == 1


def test_stored_but_not_embedded_is_pending(spark, docs, tmp_path):
    rows = staged(docs, game(1, description_raw="d"), game(2, description_raw="d"))
    store = str(tmp_path / "vectors")
    index = str(tmp_path / "index")
    assert sync_embeddings(rows.where("game_id = 1"), store, hashed_words(), index=index)["embedded"] == 1
    stored = spark.read.parquet(store)
    unfinished = stored.withColumn("embedded_at", F.lit(None).cast("timestamp"))
    assert {r.game_id for r in pending_games(rows, stored).collect()} == {2}
    assert {r.game_id for r in pending_games(rows, unfinished).collect()} == {1, 2}
    assert sync_embeddings(rows, store, hashed_words(), index=index)["embedded"] == 1
    query = embed_query(spark, "d", hashed_words())
    plain, indexed = (search(spark.read.parquet(store), query, index=i).collect() for i in (None, index))
    assert plain == indexed and len(plain) == 2
