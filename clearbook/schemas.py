"""Explicit schemas of every table and document the library reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The names of the columns here and below, which files of other writers have too.
RAW_COLUMNS = [
    "transaction_id", "customer_name", "region", "industry_segment", "product_sku",
    "order_date", "quantity", "revenue_usd", "sales_rep", "notes",
]

# Raw files are read as text throughout; typed values appear in *_clean columns.
RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

CLEAN_COLUMNS = [
    "customer_name_clean", "region_clean", "industry_segment_clean",
    "order_date_clean", "revenue_usd_clean",
]

CLEAN = T.StructType(
    RAW.fields
    + [
        T.StructField("customer_name_clean", T.StringType()),
        T.StructField("region_clean", T.StringType()),
        T.StructField("industry_segment_clean", T.StringType()),
        T.StructField("order_date_clean", T.DateType()),
        T.StructField("revenue_usd_clean", T.DoubleType()),
    ]
)

WEEKLY = "order_date_clean date, revenue double, transactions long, wow_change_pct double"

MAPPING = "domain string, dirty string, clean string, stored_at timestamp"

_CUSTOMER_ROW = (
    "struct<customer_name_clean: string, revenue: double, transactions: bigint, avg_order_value: double, "
    "rank: bigint, pct_of_total: double, cumulative_pct: double, is_pareto_80: boolean>"
)


def breakdown(dimension: str) -> str:
    return f"{dimension} string, revenue double, transactions bigint, unique_customers bigint, pct_of_total double"


def _breakdown_row(dimension: str) -> str:
    return f"struct<{breakdown(dimension).replace(' ', ': ').replace(',: ', ', ')}>"


RESULTS = (
    "dataset_summary struct<total_revenue: double, total_transactions: bigint, date_range_start: string, "
    "date_range_end: string, unique_customers: bigint, unique_segments: bigint, unique_regions: bigint>, "
    "pareto_summary struct<total_customers: bigint, pareto_customers: bigint, pareto_customer_pct: double, "
    "pareto_revenue_pct: double, top_1_customer: string, top_1_revenue_pct: double>, "
    "weekly_summary struct<weeks_covered: bigint, avg_weekly_revenue: double, best_week_revenue: double, "
    "worst_week_revenue: double, latest_week_revenue: double, latest_wow_change: double>, "
    f"top_customers array<{_CUSTOMER_ROW}>, "
    f"segment_breakdown array<{_breakdown_row('industry_segment_clean')}>, "
    f"region_breakdown array<{_breakdown_row('region_clean')}>"
)

DELIVERY = (
    "report_path string, local struct<organized_path: string, latest_path: string, index_path: string>, "
    "upload struct<status: string, reason: string>, delivered_at timestamp"
)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: list[str], origin: str) -> DataFrame:
    """The frame itself if it holds all columns; raises before any job otherwise."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{origin} is missing expected columns: {missing}. Re-run the step that writes it.")
    return df
