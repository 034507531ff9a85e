"""The cleaning job: raw transactions in, clean transactions and a cleaning report out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.functions.matching import match_closed
from clearbook.functions.vocabulary import REGIONS, SEGMENTS
from clearbook.operators.cleaning import REGION_ALIASES, SEGMENT_ALIASES, clean_transactions, name_mapping, value_columns
from clearbook.operators.mapping import apply_mapping, distinct_values, only_new, values_of
from clearbook.operators.measures import analyzable
from clearbook.operators.names import canonical_names
from clearbook.operators.profile import cleaning_report, profile_of_clean, report_document
from clearbook.operators.resolver import Resolver, closed_answers
from clearbook.sources.answers import resolve_into
from clearbook.sources.files import read_clean, scan_raw_records
from clearbook.sources.mapping_table import append_mapping, read_mapping
from clearbook.sources.staging import stage, staged_until_done

CUSTOMERS = "customers"

# domain: column, vocabulary, known spellings
CLOSED = {
    "regions": ("region", REGIONS, REGION_ALIASES),
    "segments": ("industry_segment", SEGMENTS, SEGMENT_ALIASES),
}


def refresh_names(
    raw: DataFrame,
    mapping_path: str,
    resolver: Resolver | None = None,
    values: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Bring the stored name mapping up to date with a raw table; only unseen names are worked on.

    They are clustered, with ``options`` of ``canonical_names``, or asked of the
    ``resolver`` if there is one. Returns the stored mapping together with how
    often each name occurs in the table: (dirty, clean, n). If calls of the
    resolver fail, what the others answered is stored before the error is raised.
    ``values`` is (dirty, n), the names of the table, if they are known already.
    """
    spark = raw.sparkSession
    stored = read_mapping(spark, mapping_path, CUSTOMERS)
    values = stage(distinct_values(raw, "customer_name"), "values") if values is None else values
    unseen = only_new(values, stored)
    if resolver is None:
        append_mapping(canonical_names(unseen, known=stored.select("clean"), **options), mapping_path, CUSTOMERS)
    else:
        resolve_into(unseen, mapping_path, CUSTOMERS, resolver)
    return read_mapping(spark, mapping_path, CUSTOMERS).join(values, "dirty").select("dirty", "clean", "n")


def refresh_closed(
    raw: DataFrame,
    mapping_path: str,
    domain: str,
    resolver: Resolver | None = None,
    values: DataFrame | None = None,
) -> DataFrame:
    """The same for a closed vocabulary; an answer outside it is replaced by the containment match."""
    column, vocabulary, aliases = CLOSED[domain]
    spark = raw.sparkSession
    values = stage(distinct_values(raw, column), "values") if values is None else values
    unseen = only_new(values, read_mapping(spark, mapping_path, domain))
    if resolver is None:
        new = unseen.select("dirty", match_closed(F.col("dirty"), vocabulary, aliases).alias("clean"))
        append_mapping(new, mapping_path, domain)
    else:
        resolve_into(unseen, mapping_path, domain, resolver, lambda answers: closed_answers(answers, vocabulary))
    return read_mapping(spark, mapping_path, domain).join(values, "dirty").select("dirty", "clean", "n")


def clean_with_mappings(raw: DataFrame, names: DataFrame, closed: Mapping[str, DataFrame]) -> DataFrame:
    """Raw transactions plus the five clean columns, the three texts by their stored mappings (dirty, clean, n).

    The names, of which there are most, are looked up first, so that the rows are moved without the other clean
    columns, their texts packed.
    """
    values = value_columns()
    order = raw.withColumns(values).columns
    mapped = apply_mapping(raw, "customer_name", names, "customer_name_clean", "transaction_id", counts=names, packed=True)
    for domain, pairs in closed.items():
        column = CLOSED[domain][0]
        mapped = apply_mapping(mapped, column, pairs, f"{column}_clean", "transaction_id", counts=pairs)
        values.pop(f"{column}_clean")
    return mapped.withColumns(values).select(*order, "customer_name_clean")


def run_cleaning(
    raw: DataFrame,
    output_path: str,
    report_path: str,
    mapping_path: str | None = None,
    resolvers: Mapping[str, Resolver] | None = None,
    land: bool = True,
    rejected: int = 0,
    **name_options,
) -> DataFrame:
    """Write the clean table (parquet) and the report (JSON); returns the report read back.

    The raw table is read several times: unless ``land`` is false, as it should
    be for a stored parquet table, it is landed first. ``rejected`` is how many
    damaged records the scan set aside, for the report. With ``mapping_path`` the mappings of
    all three texts are kept there and only unseen values are worked on;
    ``resolvers`` may name an external resolver for any of ``customers``,
    ``regions`` and ``segments`` and needs that path, so that a rerun asks for
    nothing again. What the job staged is deleted when it ends.
    """
    spark, resolvers = raw.sparkSession, resolvers or {}
    if resolvers and mapping_path is None:
        raise ValueError("Resolvers need a mapping_path, or every run would ask for all values again.")
    with staged_until_done(spark):
        raw = stage(raw, "raw", compression="zstd") if land else raw
        if mapping_path is None:
            cleaned = clean_transactions(raw, name_mapping(raw, **name_options))
        else:
            values = values_of(raw, ["customer_name", *(column for column, *_ in CLOSED.values())])
            names = refresh_names(raw, mapping_path, resolvers.get(CUSTOMERS), values["customer_name"], **name_options)
            names = stage(names, "names")
            closed = {
                domain: stage(refresh_closed(raw, mapping_path, domain, resolvers.get(domain), values[column]), domain)
                for domain, (column, *_) in CLOSED.items()
            }
            cleaned = clean_with_mappings(raw, names, closed)
        cleaned.write.mode("overwrite").parquet(output_path)
        report = cleaning_report(profile_of_clean(read_clean(spark, output_path)))
        method = "rules" if not resolvers else "resolver: " + ", ".join(sorted(resolvers))
        report_document(report, method, rejected).write.mode("overwrite").json(report_path)
    return spark.read.json(report_path)


def run_cleaning_file(
    spark: SparkSession,
    raw_path: str,
    output_path: str,
    report_path: str,
    rejected_path: str | None = None,
    tolerated: float = 0.0,
    **options,
) -> DataFrame:
    """The cleaning job over raw CSV files, of which up to the share ``tolerated`` of the records may be damaged.

    The damaged ones are written to ``rejected_path`` (parquet), if given, and
    counted in the report. ``options`` are those of ``run_cleaning``.
    """
    with staged_until_done(spark):
        scan = scan_raw_records(spark, raw_path, tolerated)
        if rejected_path is not None:
            scan.rejected.write.mode("overwrite").parquet(rejected_path)
        return run_cleaning(scan.rows, output_path, report_path, land=False, rejected=scan.n_rejected, **options)


def load_clean(spark: SparkSession, path: str, include_refunds: bool = False) -> DataFrame:
    """Rows of a clean table that the analysis uses."""
    return analyzable(read_clean(spark, path), include_refunds)
