"""Data-quality tests and the gate built on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(Exception):
    """Raised by ``require_clean``; lists the failing tests."""


class Tests(NamedTuple):
    """The columns of one model that must be unique and not null."""

    unique: Sequence[str] = ()
    not_null: Sequence[str] = ()


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once, with their count in ``n``."""
    values = df.select(column).where(F.col(column).isNotNull())
    return values.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, failures)`` for all columns, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("failures")) for i, c in enumerate(columns)])
    return counts.select(F.inline(rows))


def _tested(model: str, df: DataFrame, wanted: Tests) -> DataFrame:
    """All tests of one model from one scan.

    Each row gives the values of the unique columns, and an entry for each column that must not be null and is.
    These are counted by column and value, combined per task first: what is shuffled are the values that must be
    told apart anyway, and one row per column and task for the nulls.
    """
    kinds = dict(zip(df.columns, [f.dataType for f in df.schema.fields], strict=True))
    columns = list(dict.fromkeys([*wanted.unique, *wanted.not_null]))
    values = [f"v{i}" for i in range(len(wanted.unique))]

    def entry(at: int, column: str) -> Column:
        own = [(F.col(u) if u == column else F.lit(None).cast(kinds[u])).alias(v) for u, v in zip(wanted.unique, values, strict=True)]
        missing = F.col(column).isNull()
        told = F.struct(F.lit(at).alias("at"), missing.alias("missing"), *own)
        return told if column in wanted.unique else F.when(missing, told)

    entries = F.filter(F.array(*[entry(at, c) for at, c in enumerate(columns)]), lambda e: e.isNotNull())
    counts = df.select(F.inline(entries)).groupBy("at", "missing", *values).agg(F.count(F.lit(1)).alias("n"))

    def failures(column: str, test: str) -> Column:
        own = F.col("at") == columns.index(column)
        if test == "unique":
            found = F.count_if(own & ~F.col("missing") & (F.col("n") > 1))
        else:
            found = F.coalesce(F.sum(F.when(own & F.col("missing"), F.col("n"))), F.lit(0).cast("bigint"))
        return F.struct(F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit(test).alias("test"), found.alias("failures"))

    tests = [*((c, "not_null") for c in wanted.not_null), *((c, "unique") for c in wanted.unique)]
    return counts.agg(F.array(*[failures(*t) for t in tests]).alias("results")).select(F.inline("results"))


def summary(models: dict[str, DataFrame], tests: dict[str, Tests]) -> DataFrame:
    """``(model, column, test, failures)`` for every declared test: rows that are null, or values that occur
    more than once. Each model is scanned once."""
    return reduce(DataFrame.unionByName, [_tested(model, models[model], wanted) for model, wanted in tests.items() if wanted.unique or wanted.not_null])


def require_clean(result: DataFrame) -> None:
    """Raise if any test of a ``summary`` failed. Collects one row per failing test."""
    failing = result.where("failures > 0").collect()
    if failing:
        raise DataQualityError(", ".join(f"{r.model}.{r.column} {r.test}: {r.failures}" for r in failing))
