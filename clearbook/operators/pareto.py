"""Customer Pareto: ranking, running share and the tier that carries most of the revenue."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.functions.numeric import CENTS, all_cents, cents_to_amount, percent_of, round_half_even
from clearbook.operators.measures import CUSTOMER, roll_up
from clearbook.sources.staging import stage

THRESHOLD = 0.80
TOP_CUSTOMERS = 20

PARETO_COLUMNS = [
    CUSTOMER, "revenue", "transactions", "avg_order_value",
    "rank", "pct_of_total", "cumulative_pct", "is_pareto_80",
]


def customer_totals(measures: DataFrame) -> DataFrame:
    """One measure row per named customer; its cents are ordinary and large ones together."""
    totals = roll_up(measures.where(F.col(CUSTOMER).isNotNull()), CUSTOMER)
    return totals.withColumn("revenue_cents", all_cents(F.col("revenue_cents"), F.col("large_cents")))


def _average(revenue_cents: Column, priced_rows: Column) -> Column:
    return round_half_even(F.try_divide(cents_to_amount(revenue_cents), priced_rows), 2)


def customer_revenue(measures: DataFrame) -> DataFrame:
    """Revenue, transaction count and mean order value per customer."""
    return customer_totals(measures).select(
        CUSTOMER,
        round_half_even(cents_to_amount(F.col("revenue_cents")), 2).alias("revenue"),
        "transactions",
        _average(F.col("revenue_cents"), F.col("priced_rows")).alias("avg_order_value"),
    )


def _reached(running: Column, total: Column, threshold: float) -> Column:
    """Whether a running sum has the wanted share of the total (never, for a zero total)."""
    running, total = running.cast(CENTS), total.cast(CENTS)
    goal = total * F.lit(Decimal(str(threshold)))
    return F.when(total > 0, running >= goal).when(total < 0, running <= goal).otherwise(F.lit(False))


def _finish(ranked: DataFrame) -> DataFrame:
    total = cents_to_amount(F.col("total_cents"))
    share = percent_of(cents_to_amount(F.col("revenue_cents")), total)
    cumulative = percent_of(cents_to_amount(F.col("running_cents")), total)
    return ranked.select(
        CUSTOMER,
        round_half_even(cents_to_amount(F.col("revenue_cents")), 2).alias("revenue"),
        "transactions",
        _average(F.col("revenue_cents"), F.col("priced_rows")).alias("avg_order_value"),
        F.col("rank").cast("long").alias("rank"),
        round_half_even(share, 2).alias("pct_of_total"),
        round_half_even(cumulative, 2).alias("cumulative_pct"),
        "is_pareto_80",
    )


def customer_pareto(measures: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every customer with rank, shares and tier flag, in no particular row order (see ``rank``).

    Customers are range-partitioned by (revenue descending, name), so that each
    slice holds a run of neighbouring ranks and the slices are of even size
    even where many customers tie. Per-slice totals, one row per partition,
    give each slice its offset; ranks and running sums are then finished
    within the slices, side by side. No task ever sees all customers.

    The tier holds every customer up to and including the first whose running
    sum reaches the threshold; if none does, all customers.
    """
    cents = F.col("revenue_cents")
    order = [F.desc("revenue_cents"), F.asc(CUSTOMER)]
    sliced = stage(
        customer_totals(measures)
        .select(CUSTOMER, "revenue_cents", "transactions", "priced_rows")
        .repartitionByRange(*order)
        .withColumn("slice", F.spark_partition_id()),
        "pareto",
    )

    # Within a slice the running sum rises over positive revenue, then falls:
    # its highest and lowest value follow from four sums, without the rows.
    slices = sliced.groupBy("slice").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(cents).alias("cents"),
        F.sum(F.when(cents > 0, cents)).alias("gain"),
        F.max(cents).alias("first_cents"),
    )
    earlier = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("slice").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    highest = F.col("cents_before") + F.coalesce(F.col("gain"), F.col("first_cents"))
    lowest = F.col("cents_before") + F.least("first_cents", "cents")
    turning = F.when(F.col("total_cents") > 0, highest).otherwise(lowest)
    offsets = (
        slices.withColumns(
            {
                "cents_before": F.coalesce(F.sum("cents").over(earlier), F.lit(0)),
                "customers_before": F.coalesce(F.sum("customers").over(earlier), F.lit(0)),
                "total_cents": F.sum("cents").over(everything),
            }
        )
        .withColumn("reached", _reached(turning, F.col("total_cents"), threshold))
        .withColumn("reached_before", F.coalesce(F.max("reached").over(earlier), F.lit(False)))
        .select("slice", "cents_before", "customers_before", "total_cents", "reached_before")
    )

    in_slice = W.partitionBy("slice").orderBy(*order)
    running = F.col("cents_before") + F.sum(cents).over(in_slice.rowsBetween(W.unboundedPreceding, 0))
    ranked = (
        # one row per partition, so the broadcast side is bounded by the partition count
        sliced.join(F.broadcast(offsets), "slice")
        .withColumn("rank", F.col("customers_before") + F.row_number().over(in_slice))
        .withColumn("running_cents", running)
        .withColumn("reached", _reached(F.col("running_cents"), F.col("total_cents"), threshold))
        .withColumn("reached_earlier", F.max("reached").over(in_slice.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn(
            "is_pareto_80", ~(F.col("reached_before") | F.coalesce(F.col("reached_earlier"), F.lit(False)))
        )
    )
    return _finish(ranked)


def top_customers(measures: DataFrame, count: int = TOP_CUSTOMERS, threshold: float = THRESHOLD) -> DataFrame:
    """The first ``count`` rows of the Pareto table, without ranking the rest."""
    totals = stage(
        customer_totals(measures).select(CUSTOMER, "revenue_cents", "transactions", "priced_rows"), "totals"
    )
    total = totals.agg(F.sum("revenue_cents")).scalar()
    order = [F.desc("revenue_cents"), F.asc(CUSTOMER)]
    # at most ``count`` rows reach the windows
    from_first = W.orderBy(*order)
    running = F.sum("revenue_cents").over(from_first.rowsBetween(W.unboundedPreceding, 0))
    ranked = (
        totals.orderBy(*order)
        .limit(count)
        .withColumn("total_cents", total)
        .withColumn("rank", F.row_number().over(from_first))
        .withColumn("running_cents", running)
        .withColumn("reached", _reached(F.col("running_cents"), F.col("total_cents"), threshold))
        .withColumn("reached_earlier", F.max("reached").over(from_first.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("is_pareto_80", ~F.coalesce(F.col("reached_earlier"), F.lit(False)))
    )
    return _finish(ranked).orderBy("rank")


def vip_customers(pareto: DataFrame) -> DataFrame:
    return pareto.where("is_pareto_80")


def pareto_summary(pareto: DataFrame) -> DataFrame:
    """One row of headline figures; nulls for an empty table."""
    vip_share = F.sum(F.when(F.col("is_pareto_80"), F.col("pct_of_total").cast("decimal(18,2)")))
    counted = pareto.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if("is_pareto_80").alias("pareto_customers"),
        vip_share.cast("double").alias("vip_share"),
        F.min_by(CUSTOMER, "rank").alias("top_1_customer"),
        F.min_by("pct_of_total", "rank").alias("top_1_revenue_pct"),
    )
    return counted.select(
        "total_customers",
        "pareto_customers",
        round_half_even(F.try_divide(100 * F.col("pareto_customers"), F.col("total_customers")), 1).alias(
            "pareto_customer_pct"
        ),
        round_half_even(F.col("vip_share"), 1).alias("pareto_revenue_pct"),
        "top_1_customer",
        "top_1_revenue_pct",
    )
