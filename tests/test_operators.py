import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from questlake.operators import aggregate, quality, rank, series
from questlake.operators.dedup import latest_by_key
from questlake.operators.merge import enrich_merge, pending_rows, update_by_key, upsert_by_key
from questlake.operators.rank import rank_in_group, rank_rows
from questlake.operators.validate import split_window, window_bounds

END = dt.date(2026, 6, 20)


def dicts(df, *order):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: tuple(str(r[c]) for c in order))


# Release window


def test_window_bounds():
    assert window_bounds(END, 7) == (dt.date(2026, 6, 14), END)
    assert window_bounds(END, 3) == (dt.date(2026, 6, 18), END)
    today = dt.date.today()
    assert window_bounds() == (today - dt.timedelta(days=7), today - dt.timedelta(days=1))


@pytest.mark.parametrize(
    ("released", "reason"),
    [
        ("2026-06-17", None),
        (None, "missing"),
        ("", "missing"),
        ("not-a-date", "unparseable"),
        ("TBA", "unparseable"),
        ("2026-05-01", "out_of_window"),
        ("2026-07-01", "out_of_window"),
        ("2099-01-01", "out_of_window"),
        ("2026-06-14", None),
        ("2026-06-20", None),
    ],
)
def test_window_reason(spark, released, reason):
    df = spark.createDataFrame([(1, released)], "id int, released string")
    accepted, rejected = split_window(df, F.col("released"), END)
    assert accepted.count() == (reason is None)
    assert [r.reject_reason for r in rejected.collect()] == ([] if reason is None else [reason])


# Latest version


def test_latest_by_key(spark):
    at = dt.datetime
    rows = [
        (1, at(2026, 1, 1), "old"), (1, at(2026, 1, 2), "new"),
        (2, at(2026, 1, 1), "timed"), (2, None, "null time"),
        (3, at(2026, 1, 1), "b"), (3, at(2026, 1, 1), "a"),
        (None, at(2026, 1, 1), "no key"), (None, at(2026, 1, 2), "no key, newer"),
    ]
    df = spark.createDataFrame(rows, "id int, at timestamp, v string")
    got = {r.id: r.v for r in latest_by_key(df, ["id"], F.col("at"), [F.asc("v")]).collect()}
    assert got == {1: "new", 2: "null time", 3: "a", None: "no key, newer"}


def test_latest_cuts_hot_keys_before_the_shuffle(spark):
    keyed = spark.range(10).withColumn("k", F.col("id") % 3)
    plan = latest_by_key(keyed, ["k"], F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


# Joins


def test_pending_rows(spark):
    source = spark.createDataFrame([(1,), (2,), (3,), (None,), (None,)], "id int")
    stored = spark.createDataFrame([(1, "v"), (2, None), (None, "v")], "id int, vector string")
    assert {r.id for r in pending_rows(source, stored, "id").collect()} == {3, None}
    left = pending_rows(source, stored, "id", filled="vector").collect()
    assert sorted(str(r.id) for r in left) == ["2", "3", "None", "None"]


@pytest.mark.parametrize("join", [pending_rows, update_by_key])
def test_null_keys_are_spread_over_tasks(spark, join):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(9).select(F.nullif("id", F.lit(1)).alias("id"), F.lit("a").alias("name"))
        plan = join(left, left, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(keys) == 2 and all("_null_spread" in line for line in keys)


def test_enrich_merge(spark, docs):
    records = docs('{"id": 1, "rating": 4.5}', '{"id": 2, "rating": 4.0}', '{"name": "x"}', '{"id": 1, "again": true}')
    details = docs('{"id": 1, "description_raw": "d", "rating": null}', '{"id": 9, "description_raw": "other"}')
    key = F.try_variant_get("raw_data", "$.id", "bigint")
    merged = enrich_merge(records.withColumn("id", key), details.withColumn("id", key), "id")
    got = sorted((json.loads(r[0]) for r in merged.select(F.to_json("raw_data")).collect()), key=str)
    assert got == sorted(
        [
            {"id": 1, "rating": None, "description_raw": "d"},
            {"id": 1, "rating": None, "description_raw": "d", "again": True},
            {"id": 2, "rating": 4.0},
            {"name": "x"},
        ],
        key=str,
    )


def test_upsert_keeps_other_columns_and_inserts(spark):
    target = spark.createDataFrame([(1, "a", "v1", 0), (2, "b", "v2", 0)], "id int, name string, vector string, at int")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "id int, name string")
    got = upsert_by_key(target, source, "id", ["name"], {"at": F.lit(1)})
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "a", "v1", 0), (2, "B", "v2", 1), (3, "C", None, 1), (None, "N", None, 1)], key=str
    )


def test_update_ignores_unknown_keys(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "c", "z")], "id int, name string, other string")
    updates = spark.createDataFrame([(2, None), (9, "q"), (None, "r")], "id int, name string")
    got = update_by_key(target, updates, "id")
    assert got.columns == target.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "a", "x"), (2, None, "y"), (None, "c", "z")], key=str)


# Ranks


def test_ranks_with_hot_score_hot_group_and_null_group(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([1.0, 1.0, rng.random()]), rng.choice([2001, 2001, None, 2003])) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, score double, year int").repartition(8)
    order = [F.desc_nulls_first("score"), F.asc_nulls_last("id")]
    got = rank_rows(df, order, overall="overall", within={"in_year": ["year"]}).collect()
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    overall = {r[0]: n for n, r in enumerate(ordered, 1)}
    seen, in_year = {}, {}
    for key, _, year in ordered:
        seen[year] = in_year[key] = seen.get(year, 0) + 1
    assert len(got) == 5000
    assert all(r.overall == overall[r.id] and r.in_year == in_year[r.id] for r in got)


def test_rank_of_nothing(spark):
    df = spark.createDataFrame([], "id int, score double")
    assert rank_rows(df, [F.desc("score"), F.asc("id")], overall="n").count() == 0


# Series and aggregates


def test_rolling_is_by_rows_not_days(spark):
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=3 * i) for i in range(8)]
    df = spark.createDataFrame([(d, 1) for d in days], "day date, n int")
    got = series.running_sums(df, "day", "n", "rolling", "total").orderBy("day").collect()
    assert [r.rolling for r in got] == [1, 2, 3, 4, 5, 6, 7, 7]
    assert [r.total for r in got] == list(range(1, 9))


@pytest.mark.parametrize("unique", [True, False])
def test_name_listed_twice_weighs_twice_but_counts_once(spark, unique):
    rows = [(1, ["Action", "Action"], 5.0), (2, ["Action", None], 2.0), (3, [], 1.0), (4, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, names array<string>, rating double")
    df = df.withColumns({"day": F.lit("2001-05-05").cast("date"), "critic": F.lit(None).cast("int")})
    (row,) = aggregate.name_trends(df, F.col("names"), "day", "id", "rating", "critic", unique_key=unique).collect()
    assert (row.genre_name, row.release_year, row.game_count, row.avg_user_rating) == ("Action", 2001, 2, 4.0)
    assert (row.best_rating, row.worst_rating, row.avg_metacritic) == (5.0, 2.0, None)


def test_unique_key_counts_equal_distinct_counts(spark):
    rows = [(1, "2026-01-01", 1.0, None), (2, "2026-01-01", None, 50), (3, "2026-01-02", 2.0, 60), (4, None, 3.0, 1)]
    df = spark.createDataFrame(rows, "id int, day string, rating double, critic int").withColumn("day", F.to_date("day"))
    args = ("day", "id", "n", "rating", "critic", "avg", "scored")
    plain, unique = series.daily_counts(df, *args), series.daily_counts(df, *args, unique_key=True)
    assert dicts(plain, "day") == dicts(unique, "day")
    assert [(r["n"], r["avg"], r["scored"]) for r in dicts(plain, "day")] == [(2, 1.0, 1), (1, 2.0, 1)]
    for df in (plain, unique):
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_daily_counts_with_repeated_and_null_keys(spark):
    rows = [(1, 1.0, None), (1, 1.01, 5), (1, None, 5), (2, None, None), (None, 4.0, 5)]
    df = spark.createDataFrame(rows, "id int, rating double, critic int").withColumn("day", F.lit("2026-01-01").cast("date"))
    (row,) = series.daily_counts(df, "day", "id", "n", "rating", "critic", "avg", "scored").collect()
    assert (row.n, row.avg, row.scored) == (2, 2.0, 1)
    empty = series.daily_counts(df.where("id = 2"), "day", "id", "n", "rating", "critic", "avg", "scored").first()
    assert (empty.n, empty.avg, empty.scored) == (1, None, 0)


def test_string_agg_of_a_hot_key_in_pieces(spark):
    rows = spark.range(4000).selectExpr("if(id % 4 = 3, null, 'hot') AS _value", "cast(id % 3000 AS string) AS v")
    rows = rows.union(spark.createDataFrame([("empty", ""), ("empty", None), ("none", None), ("none", None)], rows.schema)).repartition(5)
    got = {r._value: r.s for r in aggregate.string_agg_distinct(rows, ["_value"], "v", "s", "|").collect()}
    want = lambda keep: "|".join(sorted({str(i % 3000) for i in range(4000) if keep(i)}))
    assert got == {"hot": want(lambda i: i % 4 != 3), None: want(lambda i: i % 4 == 3), "empty": "", "none": ""}
    assert aggregate.string_agg_distinct(rows.where("false"), ["_value"], "v", "s").collect() == []


def test_unnest_marks_first_names_of_long_rows(spark):
    rows = spark.createDataFrame([(1, ["b", None, "a", "b", None, "a"]), (2, []), (3, None), (4, [None])], "k int, n array<string>")
    got = [(r.k, r.name, r.first_in_row) for r in aggregate.unnest_names(rows, F.col("n")).collect()]
    assert sorted(got) == [(1, "a", False), (1, "a", True), (1, "b", False), (1, "b", True)]
    long = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: (i % 150_000).cast("string")).alias("n"))
    assert aggregate.unnest_names(long, F.col("n")).where("first_in_row").count() == 150_000


def test_string_agg(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert dicts(aggregate.string_agg_distinct(df, ["k"], "v", "s"), "k") == [{"k": 1, "s": "a, b"}, {"k": 2, "s": ""}]


# Quality


def test_quality_gate(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "c"), (None, "d")], "id int, name string")
    tests = {"m": quality.Tests(unique=["id", "name"], not_null=["id", "name"])}
    result = quality.summary({"m": df}, tests)
    got = {(r.column, r.test): r.failures for r in result.collect()}
    assert got == {("id", "unique"): 1, ("name", "unique"): 0, ("id", "not_null"): 2, ("name", "not_null"): 1}
    with pytest.raises(quality.DataQualityError, match="m.id not_null: 2"):
        quality.require_clean(result)
    quality.require_clean(result.where("failures = 0"))


def test_ranks_in_groups_over_many_partitions(spark, monkeypatch):
    """Groups of all sizes, NULL and '' among them, over one and many range partitions, broadcast or joined."""
    draw = random.Random(8)
    rows = [(i, draw.choice(["hot"] * 30 + [None, "", "a", "b", f"x{draw.randrange(40)}"]), draw.choice([None, 1, 2]), draw.randrange(50)) for i in range(700)]
    df = spark.createDataFrame(rows, "id int, g string, h int, v int")
    order = [F.desc("v"), F.col("id")]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for most in (1 << 20, 0):
            monkeypatch.setattr(rank, "BROADCAST_STARTS", most)
            got = rank_rows(df, order, "n", {"m": ["g"], "k": ["g", "h"]}).collect()
            alone = {r.id: r.k for r in rank_in_group(df, ["g", "h"], order, "k").collect()}
            assert len(got) == len(alone) == 700
            want = sorted(rows, key=lambda r: (-r[3], r[0]))
            seen = Counter()
            by_id = {r.id: r for r in got}
            for n, (i, g, h, _) in enumerate(want):
                seen.update([("g", g), ("gh", g, h)])
                assert (by_id[i].n, by_id[i].m, by_id[i].k, alone[i]) == (n + 1, seen[("g", g)], seen[("gh", g, h)], seen[("gh", g, h)])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_gate_counts_every_kind_of_failure(spark):
    rows = [(1, "a", 1.0, None), (1, "a", 1.0, "x"), (2, None, 0.0, "x"), (None, None, -0.0, None), (None, "b", None, "x"), (3, "c", float("nan"), "y"), (3, "d", float("nan"), "y")]
    df = spark.createDataFrame(rows, "k int, name string, v double, t string")
    tests = {"m": quality.Tests(unique=["k", "v"], not_null=["k", "name", "t"]), "n": quality.Tests(not_null=["v"]), "o": quality.Tests(unique=["name"])}
    models = {"m": df, "n": df, "o": df}
    got = {(r.model, r.column, r.test): r.failures for r in quality.summary(models, tests).collect()}
    assert got == {
        ("m", "k", "not_null"): 2, ("m", "name", "not_null"): 2, ("m", "t", "not_null"): 2, ("m", "k", "unique"): 2, ("m", "v", "unique"): 3,
        ("n", "v", "not_null"): 1, ("o", "name", "unique"): 1,
    }
    assert {r.failures for r in quality.summary({m: df.where("false") for m in models}, tests).collect()} == {0}
