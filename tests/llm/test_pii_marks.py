"""Texts that hold nothing of a kind are not searched for it."""

import pytest
from pyspark.sql import functions as F

from questlake.llm import pii

PERSONAL = [
    "plain words without any of it",
    "1 2 and 3.4 at home + more",
    "a@b.c and @ alone, x@y",
    "1.2.3.4 or 1.2.3 or 999.1.1.1 id4711x",
    "4111 1111 1111 1111 or 1-2-3-4 or 12 34",
    "+1 (555) 123-4567 or + 1 or +1",
    None,
    "",
]


@pytest.mark.parametrize("at", range(5))
def test_marks_leave_out_only_texts_without_what_counts(spark, at):
    expression, mark = [*zip(pii.EXPRESSIONS.values(), pii._MARKS.values(), strict=True), (pii._TOKEN, pii._TOKEN_MARK)][at]
    texts = spark.createDataFrame([(t,) for t in PERSONAL], "text string").select(F.coalesce("text", F.lit("")).alias("text"))
    every = F.regexp_extract_all("text", F.lit(expression), F.lit(0))
    rows = texts.select(every.alias("every"), pii._hits(expression, mark).alias("marked")).collect()
    assert any(r.marked for r in rows) and any(r.marked is None for r in rows)
    for row in rows:
        counted = [h for h in row.every if at != 2 or len(h) >= 6]
        assert row.marked == row.every if row.marked is not None else not counted
