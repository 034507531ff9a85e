"""Dated publication of report tables, the report catalogue and the newest-report view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.functions.dates import date_in_name, report_year
from clearbook.functions.text import grouped_number


def publish(
    report: DataFrame,
    folder: str,
    table: str,
    report_date: Column,
    file_format: str = "parquet",
    columns: Sequence[str] | None = None,
) -> str:
    """Write a report table, or some ``columns`` of it, under ``<table>/year=/report_date=``, a file for each date.

    Publishing the same date again replaces that date and leaves the others. A
    date's rows are dealt to its file by Spark's rebalancing: a date with more
    than a partition should hold gets several files.
    """
    path = f"{folder.rstrip('/')}/{table}"
    shown = report.columns if columns is None else list(columns)
    dated = report.select(*shown, F.year(report_date).alias("year"), report_date.alias("report_date"))
    (
        dated.hint("rebalance", "year", "report_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "report_date")
        .format(file_format)
        .save(path)
    )
    return path


def latest(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest published date (the dates come from the folder names alone)."""
    published = spark.read.parquet(path)
    newest = published.agg(F.max("report_date").alias("report_date")).scalar()
    return published.where(F.col("report_date") == newest)


def report_files(spark: SparkSession, folder: str) -> DataFrame:
    """Published files with the name of their report and their size; only the listing is read, never the content."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*")
        .load(folder)
    )
    table = F.regexp_extract("path", r"/([^/]+)/year=", 1)
    day = F.regexp_extract("path", r"report_date=(\d{4}-\d{2}-\d{2})", 1)
    return listed.select(F.concat_ws("_", table, day).alias("name"), F.col("length").alias("bytes"))


def report_catalog(files: DataFrame) -> DataFrame:
    """One row per published report, newest first: its year and date, both out of its name, and its size."""
    per_report = files.groupBy("name").agg(F.sum("bytes").alias("bytes"))
    return per_report.select(
        report_year(F.col("name")).alias("year"),
        date_in_name(F.col("name")).cast("date").alias("report_date"),
        "name",
        "bytes",
        F.concat(grouped_number(F.col("bytes") / 1024, 1), F.lit(" KB")).alias("size"),
    ).orderBy(F.desc("report_date"), "name")


def catalog_by_year(files: DataFrame) -> DataFrame:
    """Number of published dates, their size and the newest date per year, newest first; then all years (null)."""
    reports = report_catalog(files)
    return (
        reports.groupingSets([["year"], []], "year")
        .agg(
            F.count_distinct("report_date").alias("reports"),
            F.sum("bytes").alias("bytes"),
            F.max("report_date").alias("latest_report"),
        )
        .orderBy(F.desc_nulls_last("year"))
    )
