"""Weekly revenue series and its headline figures.

The windows here run over one row per week. Weeks are bounded by the calendar,
whatever the number of transactions, so ordering them in one task is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.functions.dates import week_ending
from clearbook.functions.numeric import cents_to_amount, percent_change, round_half_even
from clearbook.operators.measures import DAY, revenue_sum

PARTIAL_SHARE = 0.40


def weekly_revenue(measures: DataFrame) -> DataFrame:
    """Revenue and priced rows per week ending Sunday, without gaps, with the change in percent."""
    by_week = W.orderBy("week")
    weeks = (
        measures.where(F.col(DAY).isNotNull())
        .groupBy(week_ending(F.col(DAY)).alias("week"))
        .agg(revenue_sum().alias("revenue_cents"), F.sum("priced_rows").alias("priced_rows"))
    )
    # each week also emits the empty weeks between itself and the next one
    last_of_run = F.coalesce(F.date_sub(F.lead("week").over(by_week), 7), F.col("week"))
    run = F.sequence(F.col("week"), last_of_run, F.expr("interval 7 days"))
    filled = weeks.withColumn("run", run).select(
        "*", F.explode("run").alias(DAY)
    )
    present = F.col(DAY) == F.col("week")
    series = filled.select(
        DAY,
        F.when(present, F.coalesce(round_half_even(cents_to_amount(F.col("revenue_cents")), 2), F.lit(0.0)))
        .otherwise(0.0)
        .alias("revenue"),
        F.when(present, F.col("priced_rows")).otherwise(0).cast("long").alias("transactions"),
    )
    return series.withColumn(
        "wow_change_pct", percent_change(F.col("revenue"), F.lag("revenue").over(W.orderBy(DAY)))
    )


def weekly_summary(weekly: DataFrame) -> DataFrame:
    """One row of headline figures; no row for an empty series."""
    exact = F.sum(F.col("revenue").cast("decimal(28,2)")).cast("double")
    return weekly.agg(
        F.count(F.lit(1)).alias("weeks_covered"),
        round_half_even(F.try_divide(exact, F.count(F.lit(1))), 2).alias("avg_weekly_revenue"),
        F.max("revenue").alias("best_week_revenue"),
        F.min("revenue").alias("worst_week_revenue"),
        F.max_by("revenue", DAY).alias("latest_week_revenue"),
        F.max_by("wow_change_pct", DAY).alias("latest_wow_change"),
    ).where("weeks_covered > 0")


def trend(summary: DataFrame) -> DataFrame:
    """The latest change as an arrow and a size, for display."""
    change = F.col("latest_wow_change")
    return summary.select(
        "latest_wow_change",
        F.when(change > 0, "▲").when(change.isNotNull(), "▼").alias("arrow"),
        F.abs(change).alias("size_pct"),
    )


def mark_partial(weekly: DataFrame, share: float = PARTIAL_SHARE) -> DataFrame:
    """Add ``is_partial``: a week with fewer than ``share`` of the median week's transactions."""
    median = weekly.agg(F.median("transactions")).scalar()
    return weekly.withColumn("is_partial", F.col("transactions") < median * share)
