"""The report job: result document and weekly series in, dated report tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.operators import report_tables
from clearbook.operators.measures import REGION, SEGMENT
from clearbook.sources import files
from clearbook.sources.publication import publish


def report_from(document: DataFrame, weeks: DataFrame, segments: DataFrame, regions: DataFrame) -> dict[str, DataFrame]:
    """The report tables by name. The breakdowns are whole tables; the document shows their largest values only."""
    top = document.select(F.inline("top_customers"))
    summaries = [
        document.select(f"{name}.*") for name in ("dataset_summary", "pareto_summary", "weekly_summary")
    ]
    return {
        "kpi_tiles": report_tables.kpi_tiles(*summaries),
        "takeaway": report_tables.takeaway(summaries[1]),
        "customers": report_tables.report_customers(top),
        "segments": report_tables.report_breakdown(segments),
        "regions": report_tables.report_breakdown(regions),
        "weekly": report_tables.weekly_report(weeks),
        "weekly_chart": report_tables.weekly_complete(weeks),
        "pareto_curve": report_tables.pareto_curve(top),
    }


def run_report(
    spark: SparkSession,
    results_path: str,
    weekly_path: str,
    folder: str,
    segments_path: str | None = None,
    regions_path: str | None = None,
) -> list[str]:
    """Publish every report table under the last day of the data; returns the table paths.

    The breakdowns are read where the analysis job writes them, beside the
    result document, unless other paths are given.
    """
    beside = results_path.rstrip("/").rpartition("/")[0]
    document = files.read_results(spark, results_path)
    weeks = files.read_weekly_csv(spark, weekly_path)
    segments = files.read_breakdown(spark, segments_path or f"{beside}/segment_breakdown", SEGMENT)
    regions = files.read_breakdown(spark, regions_path or f"{beside}/region_breakdown", REGION)
    last_day = document.select(F.col("dataset_summary.date_range_end").cast("date")).scalar()
    tables = report_from(document, weeks, segments, regions)
    return [publish(table, folder, name, last_day) for name, table in tables.items()]


def deliver(
    spark: SparkSession, results_path: str, weekly_path: str, folder: str, log_path: str
) -> list[str]:
    """Publish the report, then add one record to the delivery log."""
    paths = run_report(spark, results_path, weekly_path, folder)
    document = files.read_results(spark, results_path)
    day = F.col("dataset_summary.date_range_end")
    entry = document.select(
        F.concat(F.lit("weekly_report_"), day).alias("report_path"),
        F.struct(
            F.concat(F.lit(f"{folder}/*/year="), F.left(day, F.lit(4)), F.lit("/report_date="), day).alias(
                "organized_path"
            ),
            F.lit(folder).alias("latest_path"),
            F.lit(folder).alias("index_path"),
        ).alias("local"),
        F.struct(F.lit("skipped").alias("status"), F.lit("no upload target configured").alias("reason")).alias(
            "upload"
        ),
        F.current_timestamp().alias("delivered_at"),
    )
    files.append_delivery(entry, log_path)
    return paths
