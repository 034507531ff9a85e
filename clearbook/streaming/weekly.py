"""Weekly revenue while transactions arrive.

Spark keeps one row of state for each open week, Monday to Sunday: its cents and
its number of priced rows, which are added up as in the batch job. After each
micro-batch the weeks that changed replace their partition of the result table,
so the table is always up to date and a batch that is replayed after a failure
changes nothing. The watermark closes a week when a transaction has been seen
that is more than ``lateness`` behind the week's end: its state is dropped, and
transactions for it that come later still are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clearbook.functions.numeric import CENTS, is_countable, to_cents, to_large_cents
from clearbook.operators.measures import DAY, revenue_sum

# Windows are counted from 1970-01-01, a Thursday; the first Monday came four days later.
WEEK, MONDAY = "7 days", "4 days"

DAY_SECONDS = 86_400

LATENESS = "14 days"

TABLE = f"{DAY} date, revenue_cents {CENTS}, priced_rows bigint"


def weekly_totals(clean: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """(order_date_clean, revenue_cents, priced_rows): the weeks of a stream of clean transactions, by their Sunday.

    Rows without a date belong to no week. Works on a batch as well.
    """
    amount = F.col("revenue_usd_clean")
    rows = clean.where(F.col(DAY).isNotNull()).select(
        # days since 1970 in seconds, whatever the time zone of the session
        F.timestamp_seconds(F.unix_date(DAY) * DAY_SECONDS).alias("event_time"),
        to_cents(amount).alias("revenue_cents"),
        to_large_cents(amount).alias("large_cents"),
        F.when(is_countable(amount), 1).otherwise(0).cast("long").alias("priced_rows"),
    )
    week = F.window("event_time", WEEK, WEEK, MONDAY)
    totals = rows.withWatermark("event_time", lateness).groupBy(week).agg(
        revenue_sum().alias("revenue_cents"), F.sum("priced_rows").alias("priced_rows")
    )
    sunday = F.date_from_unix_date((F.unix_seconds("window.end") / DAY_SECONDS).cast("int") - 1)
    return totals.select(sunday.alias(DAY), "revenue_cents", "priced_rows")


def follow_weeks(clean: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS) -> StreamingQuery:
    """Keep the weekly totals at ``path`` up to date from a stream until all present files are read."""

    def replace(batch: DataFrame, _batch_id: int) -> None:
        changed = batch.coalesce(1)  # a row for each week that the batch touched
        writer = changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY).parquet(path)

    return (
        weekly_totals(clean, lateness)
        .writeStream.outputMode("update")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_weeks(spark: SparkSession, path: str) -> DataFrame:
    """The totals so far as measures of weeks: what ``weekly_revenue`` takes."""
    weeks = spark.read.schema(TABLE).parquet(path)
    return weeks.withColumn("large_cents", F.lit(None).cast(CENTS))
