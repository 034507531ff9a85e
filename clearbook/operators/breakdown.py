"""Revenue by any dimension, or by several at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.numeric import all_cents, cents_to_amount, percent_of, round_half_even
from clearbook.operators.measures import CUSTOMER, REGION, SEGMENT, distinct_estimate, partials, roll_up
from clearbook.sources.staging import stage


def _figures(cents: Column, total: Column) -> list[Column]:
    revenue = cents_to_amount(cents)
    return [
        round_half_even(revenue, 2).alias("revenue"),
        F.col("transactions"),
        F.col("unique_customers"),
        round_half_even(percent_of(revenue, total), 2).alias("pct_of_total"),
    ]


def _by_each(measures: DataFrame, sets: Sequence[Sequence[str]], sums: Sequence[Column]) -> DataFrame:
    """Sums by each set of columns, out of one pass; ``dimension`` names a set's first column, the others are null."""
    columns = list(dict.fromkeys(name for names in sets for name in names))
    flags = {names[0]: f"without_{i}" for i, names in enumerate(sets)}
    grouped = measures.groupingSets(sets, *columns)
    grouped = grouped.agg(*sums, *[F.grouping(name).alias(flag) for name, flag in flags.items()])
    dimension = F.coalesce(*[F.when(F.col(flag) == 0, F.lit(name)) for name, flag in flags.items()])
    return grouped.withColumn("dimension", dimension).drop(*flags.values())


def _not_customers(dimensions: Sequence[str]) -> None:
    if CUSTOMER in dimensions:
        raise ValueError("Customers are what is counted; see pareto for revenue by customer.")


def by_each(
    measures: DataFrame, counted: Sequence[str], named: Sequence[str], plain: Sequence[str] = ()
) -> DataFrame:
    """Measures by several dimensions, all out of one pass: (dimension, all dimensions, customer, measures, customers).

    Rows by a ``counted`` dimension have the number of customers of each value;
    those by a ``named`` one are by the customer too. Neither is known of ``plain``
    ones. ``dimension`` tells which dimension a row is by; the others are null
    there. The rows by any one dimension hold each input row once.
    """
    _not_customers([*counted, *named, *plain])
    pairs = _by_each(measures, [*[[name, CUSTOMER] for name in [*counted, *named]], *[[name] for name in plain]], partials())
    customer = F.when(F.col("dimension").isin(*named), F.col(CUSTOMER)).alias(CUSTOMER)
    return pairs.groupBy("dimension", *counted, *named, *plain, customer).agg(
        *partials(), F.count(CUSTOMER).alias("customers")
    )


def breakdowns(measures: DataFrame, dimensions: Sequence[str], approximate: bool = False) -> DataFrame:
    """(dimension, value, revenue, transactions, unique_customers, pct_of_total): all ``dimensions`` out of one pass.

    Each row is expanded once for each dimension, and added up by it and the
    customer. So one large value is spread over the tasks of its customers, and
    the customers of a value are counted by adding up. ``approximate`` estimates
    them out of sketches, by the dimensions alone. Values are texts. Rows without
    a value count towards the total but get no row of their own, so the shares
    may add up to less than 100.
    """
    _not_customers(dimensions)
    sums = [F.sum(name).alias(name) for name in ("revenue_cents", "large_cents", "transactions")]
    if approximate:
        measures = roll_up(measures, *dimensions, sketched=[CUSTOMER])
        sketch = F.hll_union_agg(f"{CUSTOMER}_sketch").alias(f"{CUSTOMER}_sketch")
        named = _by_each(measures, [[dimension] for dimension in dimensions], [*sums, sketch])
        named = named.withColumns({"value": _value(dimensions), "unique_customers": distinct_estimate(CUSTOMER)})
    else:
        pairs = _by_each(measures, [[dimension, CUSTOMER] for dimension in dimensions], sums)
        customers = F.count(CUSTOMER).alias("unique_customers")
        named = pairs.groupBy("dimension", _value(dimensions).alias("value")).agg(*sums, customers)
    return _shares(named, dimensions)


def breakdowns_of(rows: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """The exact ``breakdowns`` out of measures ``by_each``, which a caller may have staged for other uses too."""
    sums = [F.sum(name).alias(name) for name in ("revenue_cents", "large_cents", "transactions")]
    named = rows.where(F.col("dimension").isin(*dimensions)).groupBy("dimension", _value(dimensions).alias("value"))
    return _shares(named.agg(*sums, F.sum("customers").alias("unique_customers")), dimensions)


def _value(dimensions: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(F.col("dimension") == name, F.col(name).cast("string")) for name in dimensions])


def _shares(named: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    # a row for each value is staged; the total is that of any dimension, rows without a value included
    groups = stage(named, "breakdowns")
    cents = all_cents(F.col("revenue_cents"), F.col("large_cents"))
    total = cents_to_amount(groups.where(F.col("dimension") == dimensions[0]).agg(F.sum(cents)).scalar())
    return (
        groups.where("value IS NOT NULL")
        .orderBy("dimension", cents.desc(), "value")
        .select("dimension", "value", *_figures(cents, total))
    )


def one_breakdown(all_of_them: DataFrame, dimension: str) -> DataFrame:
    """The rows of one dimension out of ``breakdowns``, largest first, in a column of its name."""
    rows = all_of_them.where(F.col("dimension") == dimension).drop("dimension").withColumnRenamed("value", dimension)
    return rows.orderBy(F.desc("revenue"), dimension)


def revenue_by(measures: DataFrame, dimension: str) -> DataFrame:
    """Revenue, transactions, distinct customers and share per value, largest first.

    Rows without a value count towards the total but get no row of their own,
    so the shares may add up to less than 100.
    """
    # The distinct count first shuffles by (dimension, customer), so one large
    # dimension value is spread over many tasks. A row for each value is staged,
    # and the total is read from those rows: a dimension may have many values.
    sums = measures.groupBy(dimension).agg(
        F.sum("revenue_cents").alias("revenue_cents"),
        F.sum("large_cents").alias("large_cents"),
        F.sum("transactions").alias("transactions"),
        F.count_distinct(CUSTOMER).alias("unique_customers"),
    )
    cents = all_cents(F.col("revenue_cents"), F.col("large_cents"))
    groups = stage(sums.withColumn("revenue_cents", cents).drop("large_cents"), "breakdown")
    total = cents_to_amount(groups.agg(F.sum("revenue_cents")).scalar())
    return (
        groups.where(F.col(dimension).isNotNull())
        .orderBy(F.desc("revenue_cents"), dimension)
        .select(dimension, *_figures(F.col("revenue_cents"), total))
    )


def segment_breakdown(measures: DataFrame) -> DataFrame:
    return revenue_by(measures, SEGMENT)


def region_breakdown(measures: DataFrame) -> DataFrame:
    return revenue_by(measures, REGION)


def top_rows(breakdown: DataFrame, count: int = 5) -> DataFrame:
    dimension = breakdown.columns[0]
    return breakdown.orderBy(F.desc("revenue"), dimension).limit(count)
