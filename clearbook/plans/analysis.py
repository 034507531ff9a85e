"""The analysis job: measures in, result tables and the result document out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.operators import breakdown, pareto, summary, weekly
from clearbook.operators.measures import DAY, REGION, SEGMENT, roll_up
from clearbook.sources.files import write_csv, write_results
from clearbook.sources.staging import stage, staged_until_done


@dataclass(frozen=True)
class Analysis:
    """The result tables of one analysis run."""

    dataset: DataFrame
    customers: DataFrame
    customer_summary: DataFrame
    top: DataFrame
    segments: DataFrame
    regions: DataFrame
    weeks: DataFrame
    week_summary: DataFrame


def analyze(by_customer: DataFrame, by_day: DataFrame | None = None) -> Analysis:
    """All tables from measures that hold the three dimensions, and measures that hold the day.

    Both may be added up beforehand. Without ``by_day`` the days are those of
    ``by_customer``. It is read once, and added up by segment, by region and
    customer, and by day; all tables work on these rows, of which there are as
    many as values and customers, not as combinations of segment and customer.
    """
    days = [DAY] if by_day is None else []
    cube = stage(breakdown.by_each(by_customer, counted=[SEGMENT], named=[REGION], plain=days), "cube")
    by_region = cube.where(F.col("dimension") == REGION).drop(SEGMENT)
    by_day = roll_up(cube.where(F.col("dimension") == DAY), DAY) if by_day is None else by_day
    customers = stage(pareto.customer_pareto(by_region), "customers")
    weeks = stage(weekly.weekly_revenue(by_day), "weeks")
    parts = stage(breakdown.breakdowns_of(cube, [SEGMENT, REGION]), "parts")
    # all sums, customers and regions are in the rows by region; each segment comes once more, without sums
    segments = parts.where(F.col("dimension") == SEGMENT).select(F.col("value").alias(SEGMENT))
    return Analysis(
        dataset=summary.dataset_summary(by_region.unionByName(segments, allowMissingColumns=True)),
        customers=customers,
        customer_summary=pareto.pareto_summary(customers),
        top=customers.where(F.col("rank") <= pareto.TOP_CUSTOMERS).orderBy("rank"),
        segments=breakdown.one_breakdown(parts, SEGMENT),
        regions=breakdown.one_breakdown(parts, REGION),
        weeks=weeks,
        week_summary=weekly.weekly_summary(weeks),
    )


def _one_struct(row: DataFrame):
    return row.select(F.struct(*row.columns)).scalar()


def _listed(rows: DataFrame, order_by: str, descending: bool):
    """A small table as one array in the given order."""
    position = -F.col(order_by) if descending else F.col(order_by)
    entries = rows.select(position.alias("position"), F.struct(*rows.columns).alias("row"))
    ordered = entries.agg(F.sort_array(F.collect_list(F.struct("position", "row"))).alias("entries"))
    return ordered.select(F.transform("entries", lambda entry: entry["row"])).scalar()


LISTED = 50  # rows of a breakdown that the document shows; the breakdown table has all of them


def result_document(analysis: Analysis) -> DataFrame:
    """One nested row: three summaries, the top customers and the head of the two breakdowns.

    The arrays hold the top customers and the LISTED largest values of either
    breakdown, so their size does not depend on the data.
    """
    return analysis.dataset.select(
        F.struct(*analysis.dataset.columns).alias("dataset_summary"),
        _one_struct(analysis.customer_summary).alias("pareto_summary"),
        _one_struct(analysis.week_summary).alias("weekly_summary"),
        _listed(analysis.top, "rank", descending=False).alias("top_customers"),
        _listed(breakdown.top_rows(analysis.segments, LISTED), "revenue", descending=True).alias("segment_breakdown"),
        _listed(breakdown.top_rows(analysis.regions, LISTED), "revenue", descending=True).alias("region_breakdown"),
    )


def run_analysis(by_customer: DataFrame, by_day: DataFrame | None, folder: str) -> None:
    """Write the four tables as CSV and the document as JSON into ``folder``; what was staged is deleted.

    Without ``by_day`` the days are those of ``by_customer``.
    """
    with staged_until_done(by_customer.sparkSession):
        analysis = analyze(by_customer, by_day)
        write_csv(analysis.customers.orderBy("rank"), f"{folder}/customer_pareto")
        write_csv(analysis.segments, f"{folder}/segment_breakdown")
        write_csv(analysis.regions, f"{folder}/region_breakdown")
        write_csv(analysis.weeks.orderBy(DAY), f"{folder}/weekly_revenue")
        write_results(result_document(analysis), f"{folder}/analysis_results")
