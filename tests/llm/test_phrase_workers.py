"""One worker a task merges phrases, and a run holds its own words only."""

import numpy as np
from pyspark.sql import functions as F

from questlake.llm import phrases


def test_one_worker_merges_and_names_phrases(spark, capsys):
    docs = spark.createDataFrame([("a b c d, a b",)] * 40, "text string").withColumn("lang", F.lit("en"))
    counts, _ = phrases.phrase_counts(docs, least=30)
    assert {r.phrase: r.n for r in counts.collect()}["a b"] == 80
    counts.where("n > 1").explain()
    plan = capsys.readouterr().out.splitlines()
    assert sum(line.lstrip(" :+-*").startswith("MapInArrow") for line in plan) == 1, plan


def test_a_run_knows_its_own_words_only():
    ids = phrases._Ids({b"\n": 0})
    for word in (b"z", b"unused", b"a", b"m"):
        ids[word]
    known = phrases._Vocabulary(ids, np.array([[1, 3, 4, 0]]))
    assert known.plain.to_pylist() == [b"", b"z", b"a", b"m"]
    assert known.rank[known.place[[0, 3, 4, 1]]].tolist() == [0, 1, 2, 3]
