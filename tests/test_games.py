"""How the catalog queries build their input."""

import datetime as dt

from checks import games
from questlake.session import shared_dir
from questlake.sources import hdfs
from questlake.sources.jsonl import read_raw

_PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"
_LINE = """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,
  l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"""


def _tables(spark, path):
    day = lambda d: dt.datetime(1997, 1, d)
    lines = [(o, p, 1, 1, 5.0, 1.0, 0.1, "R", "F", day(d)) for o, p, d in [(1, 1, 3), (2, 1, 9), (3, 1, 9), (4, 2, 5), (5, 9, 1), (6, None, 1)]]
    lines.append((7, 2, 1, 1, 5.0, 1.0, 0.1, "R", "F", None))
    spark.createDataFrame(lines, _LINE).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, "a", "b", "t", 3), (2, "c", "b", "t", 3), (3, "e", "b", "t", 3)], _PART).write.parquet(f"{path}/part.parquet")
    spark.createDataFrame([(1, "s", 7)], "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    return str(path)


def test_raw_rows_are_not_stored_and_each_document_is_built_once(spark, tmp_path):
    path = _tables(spark, tmp_path)
    before = hdfs.child_folders(spark, shared_dir(spark))
    staged = games.staged_games(spark, path)
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_variant_object(") == 1
    assert sorted((r.game_id, r.suggestions_count, r.name) for r in staged.collect()) == [(1, 1, "a"), (2, 1, "c")]
    assert hdfs.child_folders(spark, shared_dir(spark)) == before


def test_bronze_builds_documents_for_the_latest_line_items_only(spark, tmp_path, monkeypatch):
    path, seen = _tables(spark, tmp_path), []
    build = games.game_documents
    monkeypatch.setattr(games, "game_documents", lambda lines, parts: seen.append(lines.count()) or build(lines, parts))
    bronze = games._bronze_of_latest(spark, path)
    assert seen == [4]  # of eight line items: parts 1, 2 and 9, and those without a part
    released = read_raw(spark, f"{bronze}/games").selectExpr("variant_get(raw_data, '$.id', 'bigint') AS id", "variant_get(raw_data, '$.released', 'string') AS day")
    assert sorted(map(tuple, released.collect())) == [(1, "1997-01-09"), (2, None)]
