import pytest

#: Nulls, empty texts, ties, repeated rows and a long text; ``n_words`` and others clash with results.
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 1),
    (2, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 1),
    (2, "the quick brown fox jumps over the lazy dog and runs far away from here today", "en", "a", 1),
    (3, "The  quick\tbrown fox jumps over the lazy dog and runs far away from here today", "en", None, 1),
    (4, None, "en", "b", None),
    (5, "", None, "b", 0),
    (6, " \n\t ", "de", "b", 0),
    (None, "a text without id that is here to be found", "en", "c", 3),
    (None, None, None, None, None),
    (7, "mail me@example.org or call +1 (555) 123-4567 now", "en", "c", 3),
    (8, "word " * 30_000, "en", "c", 3),
    (9, "éa ßb çc dd", "fr", "", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge(spark):
    """The rows above, with columns that are named like results of the operators."""
    extra = "n_words, 'x' AS kept, 1.5 AS score, 7 AS shard, 'y' AS slot, 'z' AS quality_score, 3L AS row, 'k' AS key, 2 AS record_hash, 'r' AS record"
    return spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", *f"n_chars AS {extra}".split(", ")).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
