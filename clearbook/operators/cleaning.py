"""Row-level cleaning: the five ``*_clean`` columns next to the originals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.dates import parse_date
from clearbook.functions.matching import match_closed
from clearbook.functions.numeric import parse_money
from clearbook.functions.vocabulary import (
    REGION_SPELLINGS,
    REGIONS,
    SEGMENT_SPELLINGS,
    SEGMENTS,
    alias_table,
)
from clearbook.operators.mapping import apply_mapping, distinct_values
from clearbook.operators.names import canonical_names
from clearbook.sources.staging import stage

REGION_ALIASES = alias_table(REGION_SPELLINGS)
SEGMENT_ALIASES = alias_table(SEGMENT_SPELLINGS)


def value_columns() -> dict[str, Column]:
    """The four clean columns that depend on their row alone."""
    return {
        "region_clean": match_closed(F.col("region"), REGIONS, REGION_ALIASES),
        "industry_segment_clean": match_closed(F.col("industry_segment"), SEGMENTS, SEGMENT_ALIASES),
        "order_date_clean": parse_date(F.col("order_date")),
        "revenue_usd_clean": parse_money(F.col("revenue_usd")),
    }


def clean_values(raw: DataFrame) -> DataFrame:
    """The raw rows with these four; works on streams as well."""
    return raw.withColumns(value_columns())


def name_mapping(raw: DataFrame, **options) -> DataFrame:
    """Customer names of a raw table mapped to their company, staged: (dirty, clean, n, merged_by).

    ``options`` are those of ``canonical_names``.
    """
    return stage(canonical_names(distinct_values(raw, "customer_name"), **options), "names")


def clean_transactions(raw: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Raw transactions plus the five clean columns.

    ``names`` is (dirty, clean, n) and defaults to clustering the table itself.
    The names are looked up first, so that the rows are moved without the other clean columns, their texts packed.
    """
    names = name_mapping(raw) if names is None else names
    named = apply_mapping(raw, "customer_name", names, "customer_name_clean", "transaction_id", counts=names, packed=True)
    cleaned = clean_values(named)
    return cleaned.select(*[c for c in cleaned.columns if c != "customer_name_clean"], "customer_name_clean")
