import datetime as dt
import json

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from questlake.functions.numeric import rounded_avg, weighted_score
from questlake.functions.text import embed_text, joined_names, non_blank
from questlake.operators.series import daily_counts
from questlake.functions.variant import (
    Field,
    element_names,
    element_strings,
    field,
    has_key,
    iso_date,
    lenient_date,
    overlay,
)


def one(df):
    (row,) = df.collect()
    return row[0]


def values(spark, kind, *items):
    return spark.createDataFrame([(i,) for i in items], f"v {kind}")


def variant(spark, text):
    return spark.createDataFrame([(text,)], "v string").select(F.parse_json("v").alias("v"))


@pytest.mark.parametrize(
    ("text", "want"),
    [("12", 12), ("12.5", 13), ("-12.5", -13), ('"12.5"', 13), ("1e3", 1000), ('"x"', None), ("null", None)],
)
def test_integers_round(spark, text, want):
    df = variant(spark, f'{{"a": {text}}}')
    assert one(df.select(field(F.col("v"), Field("a", "$.a", "bigint"), strict=False))) == want


def test_strict_cast_raises(spark):
    df = variant(spark, '{"a": "x"}')
    with pytest.raises(Exception, match="(?i)cast"):
        df.select(field(F.col("v"), Field("a", "$.a", "int"))).collect()


def test_key_present_with_json_null(spark):
    assert one(variant(spark, '{"id": null}').select(has_key(F.col("v"), "$.id"))) is True
    assert one(variant(spark, "{}").select(has_key(F.col("v"), "$.id"))) is False


def test_lenient_date(spark):
    df = values(spark, "string", "2026-06-17", "TBA", "2026-06", "2026-6-7", "", None)
    assert [r[0] for r in df.select(lenient_date(F.col("v"))).collect()] == [dt.date(2026, 6, 17)] + [None] * 5


ISO = [
    "2026-06-17", "20260617", "2026-W25-3", "2026W253", "2026-W25", "2026W25", "2020-W53-5", "2026-W53-7", "2025-W53",
    "2026-W00-1", "2026-W25-8", "2026-W253", "2026W25-3", "2026-02-30", "2026-6-17", "TBA", "not-a-date", "2026-06", "2026",
]


@pytest.mark.parametrize("text", ISO)
def test_iso_date_agrees_with_python(spark, text):
    try:
        want = dt.date.fromisoformat(text)
    except ValueError:
        want = None
    assert one(values(spark, "string", text).select(iso_date(F.col("v")))) == want


def test_elements_of_arrays_objects_and_others(spark):
    cases = {
        '[{"name": "b"}, null, {"id": 3}, {"name": null}]': (["b", None, None, None], ["b"]),
        '{"x": {"name": "b"}}': (["b"], ["b"]),
        "[]": ([], []),
        "null": (None, []),
        "5": (None, []),
        '[{"name": ""}, {"name": "a"}, {"name": "a"}]': (["", "a", "a"], ["a", "a"]),
    }
    for text, want in cases.items():
        row = variant(spark, text).select(element_strings(F.col("v")), element_names(F.col("v"))).first()
        assert (row[0], row[1]) == want, text


def test_overlay_goes_by_key_presence(spark):
    df = variant(spark, '{"base": {"id": 1, "rating": 4.5, "n": {"a": [1]}}, "top": {"rating": null, "d": "z"}}')
    merged = overlay(F.variant_get("v", "$.base", "variant"), F.variant_get("v", "$.top", "variant"))
    assert json.loads(one(df.select(F.to_json(merged)))) == {"id": 1, "rating": None, "n": {"a": [1]}, "d": "z"}


def test_score(spark):
    df = spark.createDataFrame([(87, 4.41)], "m int, r double")
    assert one(df.select(weighted_score(F.col("m"), F.col("r")))) == 4.37


def test_rounded_avg_rounds_half_up_exactly(spark):
    assert one(values(spark, "double", 1.0, 1.01).agg(rounded_avg(F.col("v"), 2))) == 1.01
    assert one(values(spark, "double", None).agg(rounded_avg(F.col("v"), 2))) is None


def test_averages_over_the_whole_range(spark):
    """Against fractions: sums beyond 10^26, signs that cancel, halves, and many digits next to few."""
    draw = random.Random(6)
    cases = [[2e22, 2e22], [5e23, 5e23], [1e25] * 20, [2e22] * 50, [1e22, -1e22, 0.5, 0.51], [-1e22, 1.0, 2.0], [1e22, -3e22], [9e22, 1.25, -9e22]]
    cases += [[3e14, 0.005], [-3e14, -0.005], [1e14, -1e14, 0.125, 0.0, 0.0], [1e14] * 3 + [-1e14] * 3 + [0.07] * 2, [7.0], [0.0, -1e20]]
    # Whole numbers that a double holds exactly, and small ones of few digits.
    number = lambda: draw.choice([-1, 1]) * draw.choice([draw.randint(1, 60) * 10.0 ** draw.randint(0, 20), draw.randint(1, 9**9) / 1000])
    cases += [[number() for _ in range(draw.randint(1, 9))] for _ in range(120)]
    rows = spark.createDataFrame([(i, v) for i, c in enumerate(cases) for v in c], "i int, v double").withColumn("d", F.lit("2026-01-01").cast("date"))
    digits = (2, 0, 6, -4, 10)
    got = {r.i: r for r in rows.groupBy("i").agg(*[rounded_avg(F.col("v"), d).alias(f"a{n}") for n, d in enumerate(digits)]).collect()}

    def wanted(case, d):
        total = sum(Fraction(Decimal(repr(v)).quantize(Decimal("1e-12"), ROUND_HALF_UP)) for v in case)
        scaled = abs(total / len(case)) * Fraction(10) ** d
        nearest = int(scaled + Fraction(1, 2))
        return float(Fraction(nearest) / Fraction(10) ** d) * (-1 if total < 0 else 1)

    with localcontext() as context:
        context.prec = 60
        for i, case in enumerate(cases):
            large = max(map(abs, case)) >= 1e14
            for n, d in enumerate(digits):
                assert got[i][f"a{n}"] == (wanted(case, d) if large else pytest.approx(wanted(case, d), rel=1e-12, abs=1e-12)), (case, d)
        for unique in (True, False):
            for i in (0, 2, 4, 8):
                case = rows.where(F.col("i") == i).withColumn("k", F.monotonically_increasing_id())
                day = daily_counts(case, "d", "k", "v", "v", "v", "average", "scored", unique_key=unique).first()
                assert day.average == wanted(cases[i], 2)


def test_text(spark):
    df = spark.createDataFrame([("N", "A, B", "x" * 3000)], "n string, g string, d string")
    assert one(df.select(embed_text(F.col("n"), F.col("g"), F.col("d")))) == "N | A, B | " + "x" * 2000
    assert one(df.select(embed_text(F.col("n"), F.lit(""), F.lit("")))) == "N"
    assert one(df.select(embed_text(F.lit(None), F.col("g"), F.lit(None)))) == "A, B"
    assert len(one(df.select(embed_text(F.col("n"), F.lit(""), F.col("d"), None)))) == 3004
    blanks = values(spark, "string", "", "   ", None, " a ").select(non_blank(F.col("v"))).collect()
    assert [r[0] for r in blanks] == [False, False, False, True]
    assert one(df.select(joined_names(F.array(F.lit("b"), F.lit(None), F.lit("a"), F.lit("b"))))) == "a, b"
