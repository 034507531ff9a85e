"""Before/after profile of a cleaning run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.dates import parse_date
from clearbook.functions.matching import match_closed
from clearbook.functions.numeric import parse_money, round_half_even
from clearbook.functions.vocabulary import REGIONS, SEGMENTS
from clearbook.operators.cleaning import REGION_ALIASES, SEGMENT_ALIASES
from clearbook.operators.mapping import distinct_values, one_pair_each
from clearbook.operators.names import canonical_names
from clearbook.sources.staging import stage

DIRTY_COLUMNS = ["customer_name", "region", "industry_segment"]


def dirty_triples(raw: DataFrame) -> DataFrame:
    """Distinct combinations of the three free-text columns."""
    return raw.select(
        F.col("customer_name").alias("dirty_customer"),
        F.col("region").alias("dirty_region"),
        F.col("industry_segment").alias("dirty_segment"),
    ).distinct()


def cleaning_profile(raw: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """One row: rows, distinct values before and after, missing revenues, unparseable dates.

    One pass adds up the rows by the values of each of the three text columns,
    and over all, as grouping sets; what is left is a row for each spelling.
    Name clustering, cleaning and the distinct counts work on those.
    """
    facts = raw.select(
        *DIRTY_COLUMNS,
        F.col("revenue_usd").isNull().alias("no_revenue"),
        parse_money(F.col("revenue_usd")).isNull().alias("no_clean_revenue"),
        parse_date(F.col("order_date")).isNull().alias("no_date"),
    )
    sets = [[column] for column in DIRTY_COLUMNS]
    spellings = stage(
        facts.groupingSets([*sets, []], *DIRTY_COLUMNS).agg(
            *[F.grouping(column).alias(f"without_{column}") for column in DIRTY_COLUMNS],
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(column).alias(column) for column in ("no_revenue", "no_clean_revenue", "no_date")],
        ),
        "spellings",
    )

    def values(column: str) -> DataFrame:
        """(dirty, n) of one column, null included."""
        return spellings.where(F.col(f"without_{column}") == 0).select(F.col(column).alias("dirty"), F.col("rows").alias("n"))

    customers = values("customer_name")
    if names is None:
        names = stage(canonical_names(customers), "names")
    named = customers.join(one_pair_each(names), "dirty", "left").select(F.coalesce("clean", "dirty").alias("clean"))
    dirty = F.col("dirty")
    after = {
        "customers": named,
        "regions": values("region").select(match_closed(dirty, REGIONS, REGION_ALIASES).alias("clean")),
        "segments": values("industry_segment").select(match_closed(dirty, SEGMENTS, SEGMENT_ALIASES).alias("clean")),
    }
    everything = spellings.where(" AND ".join(f"without_{column} = 1" for column in DIRTY_COLUMNS))

    def distinct(frame: DataFrame, column: str):
        return frame.agg(F.count_distinct(column)).scalar()

    # with no rows there is no row for all of them either
    return everything.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *[
            F.any_value(distinct(values(column), "dirty")).alias(f"before_{name}")
            for name, column in zip(after, DIRTY_COLUMNS, strict=True)
        ],
        F.coalesce(F.sum("no_revenue"), F.lit(0)).alias("before_null_revenues"),
        *[F.any_value(distinct(frame, "clean")).alias(f"after_{name}") for name, frame in after.items()],
        F.coalesce(F.sum("no_clean_revenue"), F.lit(0)).alias("after_null_revenues"),
        F.coalesce(F.sum("no_date"), F.lit(0)).alias("unparseable_dates"),
    )


def profile_of_clean(clean: DataFrame) -> DataFrame:
    """The same profile out of a clean table, which holds the old texts beside the new ones."""
    return clean.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("customer_name").alias("before_customers"),
        F.count_distinct("region").alias("before_regions"),
        F.count_distinct("industry_segment").alias("before_segments"),
        F.count_if(F.col("revenue_usd").isNull()).alias("before_null_revenues"),
        F.count_distinct("customer_name_clean").alias("after_customers"),
        F.count_distinct("region_clean").alias("after_regions"),
        F.count_distinct("industry_segment_clean").alias("after_segments"),
        F.count_if(F.col("revenue_usd_clean").isNull()).alias("after_null_revenues"),
        F.count_if(F.col("order_date_clean").isNull()).alias("unparseable_dates"),
    )


def text_shapes(df: DataFrame, column: str, value: Column) -> DataFrame:
    """(shape, n, without_value): the forms that a text column comes in, and the rows of each whose ``value`` is null.

    A run of digits is shown as 9, a run of letters as a.
    """
    shape = F.regexp_replace(F.regexp_replace(column, "[0-9]+", "9"), "[A-Za-z]+", "a")
    return df.groupBy(shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(value.isNull()).alias("without_value")
    )


def vocabulary_share(df: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    """(dirty, n, in_vocabulary): the distinct values of a column that should be one of a vocabulary."""
    values = distinct_values(df, column)
    return values.select("dirty", "n", F.col("dirty").isin(*vocabulary).alias("in_vocabulary"))


def needs_cleaning(raw: DataFrame) -> DataFrame:
    """Per transaction which of its texts are not yet in the form that the analysis takes."""
    amount = F.col("revenue_usd")
    return raw.select(
        "transaction_id",
        (~F.col("region").isin(*REGIONS)).alias("region"),
        (~F.col("industry_segment").isin(*SEGMENTS)).alias("industry_segment"),
        (~F.col("order_date").rlike(r"^\d{4}-\d{2}-\d{2}$")).alias("order_date"),
        F.coalesce(~amount.rlike(r"^[0-9]+\.[0-9]{2}$"), F.lit(True)).alias("revenue_usd"),
    )


def _reduction(after: str, before: str) -> Column:
    return round_half_even((1 - F.try_divide(F.col(after), F.col(before))) * 100, 1)


def cleaning_report(profile: DataFrame) -> DataFrame:
    """The profile plus by how many percent the distinct values went down."""
    return profile.withColumns(
        {
            "customers_pct": _reduction("after_customers", "before_customers"),
            "regions_pct": _reduction("after_regions", "before_regions"),
            "segments_pct": _reduction("after_segments", "before_segments"),
        }
    )


def report_document(report: DataFrame, method: str = "rules", rejected: int = 0) -> DataFrame:
    """The cleaning report as one nested row, for JSON; ``rejected`` records of the input were damaged and are no rows."""
    return report.select(
        F.struct(
            "rows",
            F.col("before_customers").alias("unique_customers"),
            F.col("before_regions").alias("unique_regions"),
            F.col("before_segments").alias("unique_segments"),
            F.col("before_null_revenues").alias("null_revenues"),
        ).alias("before"),
        F.struct(
            F.col("after_customers").alias("unique_customers"),
            F.col("after_regions").alias("unique_regions"),
            F.col("after_segments").alias("unique_segments"),
            F.col("after_null_revenues").alias("null_revenues"),
            "unparseable_dates",
        ).alias("after"),
        F.struct("customers_pct", "regions_pct", "segments_pct").alias("reductions"),
        F.lit(method).alias("method"),
        F.col("rows").alias("rows_processed"),
        F.lit(rejected).cast("long").alias("records_rejected"),
    )
