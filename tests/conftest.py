import pytest

from questlake.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def docs(spark):
    """A raw table from JSON lines, all loaded at one time."""

    def build(*lines: str, loaded_at: str | None = "2026-06-20 03:00:00"):
        rows = spark.createDataFrame([(line, loaded_at) for line in lines], "value string, at string")
        return rows.selectExpr("parse_json(value) AS raw_data", "cast(at AS timestamp) AS loaded_at")

    return build
