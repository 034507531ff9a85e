"""Rule checks on a raw table: all metrics in one aggregation, one row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import display_label
from clearbook.schemas import RAW_COLUMNS, missing_columns

# Bounds for the share of missing revenues: 50 and 400 in 5,000 rows.
NULL_REVENUE_SHARE = (0.01, 0.08)


def _checks(metrics: DataFrame, rules: list[tuple]) -> DataFrame:
    listed = F.array(
        *[
            F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), detail.cast("string").alias("detail"))
            for name, passed, detail in rules
        ]
    )
    return metrics.select(F.inline(listed))


def column_check(df: DataFrame, required: list[str] = RAW_COLUMNS) -> DataFrame:
    """One row per required column: whether the table has it, how many rows fill it, and its heading in reports."""
    present = [name for name in required if name in df.columns]
    filled = df.agg(*[F.count(name).alias(name) for name in present]) if present else df.limit(0).agg(F.lit(0))
    listed = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(name in present).alias("present"),
            (F.col(name) if name in present else F.lit(0).cast("long")).alias("filled_rows"),
            F.lit(display_label(name)).alias("label"),
        )
        for name in required
    ]
    return filled.select(F.inline(F.array(*listed)))


def quality_checks(
    raw: DataFrame,
    expected_rows: int | Column,
    required: list[str] = RAW_COLUMNS,
    min_customers: int = 50,
    min_regions: int = 15,
    null_share: tuple[float, float] = NULL_REVENUE_SHARE,
    min_date_lengths: int = 3,
) -> DataFrame:
    """(check_name, passed, detail) for every rule plus the overall verdict.

    ``expected_rows`` is what the sender of the table says. The rows are first
    added up by the texts that are counted, so that the distinct counts expand
    those and not the rows.
    """
    checked = raw.groupBy("customer_name", "region", F.length("order_date").alias("date_length")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("revenue_usd").isNull()).alias("nulls"),
        F.bool_or(F.col("revenue_usd").contains("$")).alias("dollars"),
    )
    metrics = checked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_distinct("customer_name").alias("customers"),
        F.count_distinct("region").alias("regions"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
        F.count_distinct("date_length").alias("date_lengths"),
        F.coalesce(F.bool_or("dollars"), F.lit(False)).alias("dollars"),
    )
    low, high = null_share
    rows = F.col("rows")
    rules = [
        ("row_count", rows == expected_rows, rows),
        ("required_columns", F.lit(not missing_columns(raw, required)), F.lit(len(required))),
        ("messy_customers", F.col("customers") > min_customers, F.col("customers")),
        ("messy_regions", F.col("regions") > min_regions, F.col("regions")),
        ("null_revenue_share", F.col("nulls").between(rows * low, rows * high), F.col("nulls")),
        ("mixed_date_formats", F.col("date_lengths") >= min_date_lengths, F.col("date_lengths")),
        ("dollar_texts", F.col("dollars"), F.col("dollars")),
    ]
    verdict = rules[0][1]
    for _, passed, _ in rules[1:]:
        verdict = verdict & passed
    return _checks(metrics, rules + [("all_passed", verdict, F.lit(len(rules)))])
