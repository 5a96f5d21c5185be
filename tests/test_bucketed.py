import re
import uuid

import pytest
from pyspark.sql import functions as F

from questlake.operators.merge import pending_rows, upsert_by_key
from questlake.sources.bucketed import open_bucketed, pending_in_buckets, upsert_in_buckets, write_bucketed


@pytest.fixture
def stored(spark, tmp_path):
    rows = [(i, f"v{i}" if i % 3 else None) for i in range(200)] + [(None, "x")] * 50
    df = spark.createDataFrame(rows, "id long, v string").repartition(5)
    name = f"stored_{uuid.uuid4().hex}"
    yield write_bucketed(df, name, f"{tmp_path}/t", "id", 16), name, f"{tmp_path}/t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(i, i) for i in range(0, 300, 2)] + [(None, 1), (None, 2), (7, 7), (7, 7)], "id long, n long").repartition(3)


@pytest.mark.parametrize("filled", [None, "v"])
def test_finds_what_the_plain_join_finds(stored, source, filled):
    want = sorted(pending_rows(source, stored[0], "id", filled=filled).collect(), key=str)
    assert sorted(pending_in_buckets(source, stored[0], "id", 16, filled=filled).collect(), key=str) == want


def test_the_stored_side_is_not_shuffled(stored, source):
    joined = pending_in_buckets(source.where("id IS NOT NULL"), stored[0], "id", 16)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1 and "BroadcastExchange" not in plan
    scan = next(line for line in plan.split("\n") if stored[1] in line)
    assert "Bucketed: true" in scan
    above = plan[: plan.index(scan)].split("SortMergeJoin")[1]
    right = above[above.rindex("Sort [") :]  # from the join's last child down to the stored scan
    assert "Exchange" not in right


def test_another_session_names_the_folder(spark, stored, source):
    before = sorted(pending_in_buckets(source, stored[0], "id", 16).collect(), key=str)
    spark.sql(f"DROP TABLE {stored[1]}")
    again = open_bucketed(spark, stored[1], stored[2], "id", 16)
    assert again.count() == 250
    assert sorted(pending_in_buckets(source, again, "id", 16).collect(), key=str) == before


def test_each_bucket_of_keys_is_one_file(spark, stored):
    files = [r.f for r in spark.table(stored[1]).where("id IS NOT NULL").selectExpr("input_file_name() f").distinct().collect()]
    assert len(files) == len({re.search(r"_(\d{5})", f).group(1) for f in files}) <= 16


def test_an_empty_table_leaves_all_pending(spark, source, tmp_path):
    name = f"empty_{uuid.uuid4().hex}"
    none = write_bucketed(spark.createDataFrame([], "id long, v string"), name, f"{tmp_path}/e", "id", 4)
    assert pending_in_buckets(source, none, "id", 4).count() == source.count()
    spark.sql(f"DROP TABLE {name}")


def test_upsert_equals_the_plain_one_and_shuffles_the_source_only(spark, stored, source, tmp_path):
    new = source.where("n <> 7").select("id", F.concat(F.lit("new"), "n").alias("v"))
    for update in (["v"], []):
        plain = upsert_by_key(stored[0], new, "id", update, {"v": F.lit("s")} if not update else None)
        merged = upsert_in_buckets(stored[0], new, "id", 16, update, {"v": F.lit("s")} if not update else None)
        assert sorted(merged.collect(), key=str) == sorted(plain.collect(), key=str)
    merged = upsert_in_buckets(stored[0], new, "id", 16, ["v"])
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    name = f"merged_{uuid.uuid4().hex}"
    again = write_bucketed(merged, name, f"{tmp_path}/m", "id", 16, aligned=True)
    assert sorted(again.collect(), key=str) == sorted(merged.collect(), key=str)
    files = [r.f for r in again.where("id IS NOT NULL").selectExpr("input_file_name() f").distinct().collect()]
    assert len(files) == len({re.search(r"_(\d{5})", f).group(1) for f in files}) <= 16
    left = pending_in_buckets(new, again, "id", 16).collect()
    assert {r.id for r in left} == {None}
    spark.sql(f"DROP TABLE {name}")
