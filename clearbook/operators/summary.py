"""Headline figures of the whole dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.functions.numeric import all_cents, cents_to_amount, round_half_even
from clearbook.operators.measures import CUSTOMER, REGION, SEGMENT, distinct_estimate, revenue_sum, roll_up

COUNTED = {"unique_customers": CUSTOMER, "unique_segments": SEGMENT, "unique_regions": REGION}


def dataset_summary(measures: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: total revenue, rows, date range as text, distinct customers, segments and regions.

    The distinct counts are exact, for which Spark expands each row once for
    each of them. ``approximate`` estimates them out of sketches instead, those
    that the measures have or new ones: nothing is expanded, and each task sends
    on one row.
    """
    if approximate:
        whole = roll_up(measures, sketched=list(COUNTED.values()))
        cents = all_cents(F.col("revenue_cents"), F.col("large_cents"))
        rows, first, last = F.col("row_count"), F.col("first_day"), F.col("last_day")
        counts = {name: distinct_estimate(dimension) for name, dimension in COUNTED.items()}
    else:
        whole = measures
        cents, rows, first, last = revenue_sum(), F.sum("row_count"), F.min("first_day"), F.max("last_day")
        counts = {name: F.count_distinct(dimension) for name, dimension in COUNTED.items()}
    columns = [
        round_half_even(cents_to_amount(cents), 2).alias("total_revenue"),
        rows.alias("total_transactions"),
        F.date_format(first, "yyyy-MM-dd").alias("date_range_start"),
        F.date_format(last, "yyyy-MM-dd").alias("date_range_end"),
        *[count.alias(name) for name, count in counts.items()],
    ]
    return whole.select(*columns) if approximate else whole.agg(*columns)
