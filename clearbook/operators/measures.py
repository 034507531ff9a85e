"""Additive measures: the form all analytics operators take their input in.

A measure frame holds, next to the dimensions, partial aggregates at some
grain: one row per transaction, per order, per customer, or any other. Sums of
partials are exact (whole cents), so a caller may aggregate before a join or a
shuffle and get the same results from far fewer rows.

A frame may also hold sketches of the values of a dimension. They are partials
like the sums: ``roll_up`` unites them, and ``distinct_estimate`` reads them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.numeric import all_cents, finite, is_countable, is_countable_gain, to_cents, to_large_cents

CUSTOMER = "customer_name_clean"
REGION = "region_clean"
SEGMENT = "industry_segment_clean"
DAY = "order_date_clean"

# revenue_cents and large_cents: those of ordinary amounts and of large ones (null where there are none);
# row_count: rows; transactions: rows with an id; priced_rows: rows with revenue
SUMS = ["revenue_cents", "large_cents", "row_count", "transactions", "priced_rows"]

# Sketches have 2 ** SKETCH_BITS registers: 4 KB, and a standard error below 1.7 %. Few values are counted exactly.
SKETCH_BITS = 12
SKETCH = "_sketch"


def measures_of(
    transaction_id: Column, revenue: Column, day: Column
) -> dict[str, Column]:
    """The measure columns of a single transaction."""
    return {
        "revenue_cents": to_cents(revenue),
        "large_cents": to_large_cents(revenue),
        "row_count": F.lit(1).cast("long"),
        "transactions": F.when(transaction_id.isNotNull(), 1).otherwise(0).cast("long"),
        "priced_rows": F.when(is_countable(revenue), 1).otherwise(0).cast("long"),
        "first_day": day,
        "last_day": day,
    }


def to_measures(clean: DataFrame) -> DataFrame:
    """Clean transactions -> measures at transaction grain, with all four dimensions."""
    measures = measures_of(F.col("transaction_id"), F.col("revenue_usd_clean"), F.col(DAY))
    return clean.select(CUSTOMER, REGION, SEGMENT, DAY, *[c.alias(name) for name, c in measures.items()])


def partials() -> list[Column]:
    """Aggregates: the measure columns of a group."""
    return [
        *[F.sum(name).alias(name) for name in SUMS],
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    ]


def roll_up(measures: DataFrame, *keys: str, sketched: Sequence[str] = ()) -> DataFrame:
    """Add partials up to a coarser grain; partials combine map-side before the shuffle.

    For each dimension in ``sketched`` there is a sketch of its values; sketches
    that the frame already has are united.
    """
    older = [name for name in measures.columns if name.endswith(SKETCH)]
    newer = [name for name in sketched if f"{name}{SKETCH}" not in older]
    return measures.groupBy(*keys).agg(
        *partials(),
        *[F.hll_union_agg(name).alias(name) for name in older],
        *[F.hll_sketch_agg(F.col(name), SKETCH_BITS).alias(f"{name}{SKETCH}") for name in newer],
    )


def distinct_estimate(dimension: str) -> Column:
    """About how many values of a dimension the sketch has seen."""
    return F.coalesce(F.hll_sketch_estimate(f"{dimension}{SKETCH}"), F.lit(0))


def revenue_sum() -> Column:
    """Aggregate: all cents of a group, ordinary and large, as a decimal."""
    return all_cents(F.sum("revenue_cents"), F.sum("large_cents"))


def analyzable(clean: DataFrame, include_refunds: bool = False) -> DataFrame:
    """Rows the analysis uses: revenue countable and, unless refunds are wanted, not negative."""
    revenue = F.col("revenue_usd_clean")
    return clean.where(is_countable(revenue) if include_refunds else is_countable_gain(revenue))


def exclusion_counts(clean: DataFrame, include_refunds: bool = False) -> DataFrame:
    """One row: how many rows the analysis drops, and why; the reasons and the rest add up to all rows.

    NaN and the infinities are no revenue, like null.
    """
    revenue = F.col("revenue_usd_clean")
    counted, dropped = is_countable(revenue), F.lit(not include_refunds) & (revenue < 0)
    return clean.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(finite(revenue).isNull()).alias("null_revenue"),
        F.count_if(finite(revenue).isNotNull() & ~counted).alias("oversized_revenue"),
        F.count_if(counted & dropped).alias("negative_revenue"),
        F.count_if(counted & ~dropped).alias("analyzable"),
    )
