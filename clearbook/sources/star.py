"""Transactions out of the provided star schema (lineitem, orders, customer, ...).

All joins are left joins to tables with unique keys, so every line item stays
and a dimension that a query does not use is simply not joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.functions.vocabulary import REGIONS, SEGMENTS
from clearbook.operators import dirt
from clearbook.operators.measures import CUSTOMER, DAY, REGION, SEGMENT, measures_of, roll_up

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transaction_id() -> Column:
    return F.concat_ws("-", *[F.col(key).cast("string") for key in LINE_KEYS])


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def order_measures(spark: SparkSession, folder: str) -> DataFrame:
    """Measures per order, with the customer key and the order day.

    Line items are added up per order before they meet the orders: the join
    then sees each order key once, however many line items one order holds.
    """
    line = measures_of(transaction_id(), F.col("l_extendedprice"), F.lit(None).cast("date"))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", *[column.alias(name) for name, column in line.items()]
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", order_day().alias(DAY))
    return (
        roll_up(lines, "l_orderkey")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .withColumns({"first_day": F.col(DAY), "last_day": F.col(DAY)})
        .drop("l_orderkey", "o_orderkey")
    )


def with_customers(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """Order measures -> measures per customer with name, region and market segment.

    Again added up first, so the join sees each customer key once.
    """
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # nation and region are fixed lists of 25 and 5 rows
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, folder, "region").select("r_regionkey", "r_name")
    return (
        roll_up(orders, "o_custkey")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .withColumnsRenamed({"c_name": CUSTOMER, "r_name": REGION, "c_mktsegment": SEGMENT})
        .drop("o_custkey", "c_custkey", "c_nationkey", "n_nationkey", "n_regionkey", "r_regionkey")
    )


def customer_measures(spark: SparkSession, folder: str) -> DataFrame:
    return with_customers(spark, folder, order_measures(spark, folder))


def _picked(values: list[str], position: Column) -> Column:
    return F.try_element_at(F.split(F.lit("\n".join(values)), "\n"), (position + 1).cast("int"))


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(*LINE_KEYS, "l_quantity", "l_extendedprice")


def base_transactions(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """One row per line item with the true customer, region and segment behind its texts.

    The customer's name follows from its key (``c_name`` is written that way,
    which a test checks), so that it needs no join. Line items meet the orders in
    a shuffled join, whose hot keys Spark can split; its plan is the same for a
    file of one split and for thousands. ``lines`` are the line items, if they
    have met other tables before.
    """
    lines = line_items(spark, folder) if lines is None else lines
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", order_day().alias("order_day")
    )
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return (
        lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .drop("o_orderkey")
        .withColumns(
            {
                "transaction_id": transaction_id(),
                "company": name,
                "true_region": _picked(REGIONS, F.col("o_custkey") % len(REGIONS)),
                "true_segment": _picked(SEGMENTS, F.col("l_partkey") % len(SEGMENTS)),
            }
        )
    )


def _line_selector(bound: int, *weights: int) -> Column:
    return dirt.selector(bound, *zip(LINE_KEYS, weights))


def name_column() -> Column:
    # a letter of the word before the number, from the second one on
    position = (_line_selector(7, 2, 3, 5, 1) + 2).cast("int")
    return dirt.written_name(F.col("company"), _line_selector(100, 31, 17, 7, 13), position)


def region_column() -> Column:
    return dirt.written_region(F.col("true_region"), _line_selector(30, 7, 1, 13, 11))


def segment_column() -> Column:
    return dirt.written_segment(F.col("true_segment"), F.floor(_line_selector(180, 11, 3, 1, 7) / 6))


def date_column() -> Column:
    return dirt.written_date(F.col("order_day"), _line_selector(6, 1, 5, 3, 4))


def amount_column() -> Column:
    return dirt.written_amount(F.col("l_extendedprice"), _line_selector(1000, 13, 57, 19, 23))


def note_column() -> Column:
    return dirt.written_note(F.col("o_orderpriority"), _line_selector(70, 3, 7, 1, 9))


def dirty_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table: ten text columns, dirty in the ways the cleaning job has to undo.

    Line items meet the parts and suppliers before the orders, so that no join
    moves the texts, which are made last.
    """
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    lines = (
        line_items(spark, folder)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .drop("p_partkey", "s_suppkey")
    )
    return base_transactions(spark, folder, lines).select(
        "transaction_id",
        name_column().alias("customer_name"),
        region_column().alias("region"),
        segment_column().alias("industry_segment"),
        F.col("p_brand").alias("product_sku"),
        date_column().alias("order_date"),
        F.col("l_quantity").cast("long").cast("string").alias("quantity"),
        amount_column().alias("revenue_usd"),
        F.col("s_name").alias("sales_rep"),
        note_column().alias("notes"),
    )


def dirty_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The raw table without the columns that need the part and supplier joins."""
    return base_transactions(spark, folder).select(
        "transaction_id",
        name_column().alias("customer_name"),
        region_column().alias("region"),
        segment_column().alias("industry_segment"),
        date_column().alias("order_date"),
        amount_column().alias("revenue_usd"),
    )
