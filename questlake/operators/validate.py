"""Release-window validation with a reason for each dropped row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlake.functions.bound import bound
from questlake.functions.variant import iso_date

# The reasons reported for dropped rows.
MISSING = "missing"
UNPARSEABLE = "unparseable"
OUT_OF_WINDOW = "out_of_window"


def window_bounds(as_of: dt.date | None = None, days: int = 7) -> tuple[dt.date, dt.date]:
    """First and last day of the window; without ``as_of`` it ends yesterday."""
    end = as_of or dt.date.today() - dt.timedelta(days=1)
    return end - dt.timedelta(days=days - 1), end


def reject_reason(released: Column, start: dt.date, end: dt.date) -> Column:
    """NULL for text that is a date within ``[start, end]``, else why it is not."""

    def judge_day(day: Column) -> Column:
        inside = day.between(F.lit(start), F.lit(end))
        return F.when(day.isNull(), UNPARSEABLE).when(~inside, OUT_OF_WINDOW)

    def judge(text: Column) -> Column:
        return F.when(text.isNull() | (text == ""), MISSING).otherwise(bound(iso_date(text), judge_day))

    return bound(released, judge)


def with_reason(df: DataFrame, released: Column, start: dt.date, end: dt.date) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason(released, start, end))


def split_window(
    df: DataFrame, released: Column, as_of: dt.date | None = None, days: int = 7
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``; rejected rows carry ``reject_reason``."""
    judged = with_reason(df, released, *window_bounds(as_of, days))
    return (
        judged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
        judged.where(F.col("reject_reason").isNotNull()),
    )
