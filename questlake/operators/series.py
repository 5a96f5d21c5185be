"""Daily counts and running sums over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlake.functions.numeric import SCALE, limb_ratio, limbs, rounded_ratio


def daily_counts(
    df: DataFrame,
    day: str,
    key: str,
    counted: str,
    averaged: str,
    scored: str,
    average: str,
    scored_count: str,
    unique_key: bool = False,
    digits: int = 2,
    scale: int = SCALE,
) -> DataFrame:
    """Per day: distinct keys (as ``counted``), rounded average of ``averaged`` and distinct
    keys that have ``scored``. Rows without a day are left out.

    ``unique_key=True`` says that no key occurs twice in ``df``; plain counts then give the
    same result and only one row per day and task is shuffled. Otherwise rows are first
    combined per (day, key), which serves both distinct counts with one shuffle of each row.
    Averages are rounded to ``digits`` and treat NaN and very large values as ``rounded_avg`` does.
    """
    dated = df.where(F.col(day).isNotNull())
    high, low = limbs(F.col(averaged), scale)
    has_score = F.col(scored).isNotNull()
    unfit = F.when(low.isNull(), F.col(averaged).cast("double"))
    if unique_key:
        measures = [high.alias("_high"), low.alias("_low"), unfit.alias("_unfit"), F.col(averaged).alias("_value"), has_score.alias("_scored")]
        rows = dated.select(day, key, *measures).withColumn("_n", F.when(F.col("_value").isNotNull(), 1))
    else:
        rows = dated.groupBy(day, key).agg(
            F.sum(high).alias("_high"), F.sum(low).alias("_low"), F.sum(unfit).alias("_unfit"), F.count(averaged).alias("_n"), F.bool_or(has_score).alias("_scored")
        )
    count, highs, lows = F.coalesce(F.sum("_n"), F.lit(0)), F.sum("_high"), F.sum("_low")
    total = F.coalesce(highs.cast("double") * 10.0 ** (22 - scale), F.lit(0.0)) + F.coalesce(lows.cast("double"), F.lit(0.0)) + F.sum("_unfit")
    exactly = rounded_ratio(lows, count, digits)
    if scale <= SCALE:
        exactly = F.when(highs.isNotNull(), limb_ratio(highs, lows, count, digits, scale)).otherwise(exactly)
    return rows.groupBy(day).agg(
        F.count(key).alias(counted),
        F.when(F.sum("_unfit").isNotNull(), F.round(total / count, digits)).otherwise(exactly).alias(average),
        F.count(F.when(F.col("_scored"), F.col(key))).alias(scored_count),
    )


def running_sums(
    daily: DataFrame, day: str, value: str, rolling: str, cumulative: str, rows: int = 7
) -> DataFrame:
    """Rolling sum over the last ``rows`` rows (not calendar days) and cumulative sum.

    The window has no partition key: ``daily`` must hold one row per day. The date type has
    3.7 million values at most, which bounds that task.
    """
    by_day = Window.orderBy(day)
    total: Column = F.sum(value)
    return daily.withColumns(
        {
            rolling: total.over(by_day.rowsBetween(-(rows - 1), Window.currentRow)),
            cumulative: total.over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
