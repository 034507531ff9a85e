"""Dirty-to-clean mappings: lookup, unseen values, upsert, vocabulary check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import has_text
from clearbook.names import unused_name
from clearbook.operators.packing import pack, text_columns, unpack
from clearbook.sources.staging import stage

# A value is hot when it holds at least this share of all rows; at most
# 1 / HOT_SHARE values can, which bounds what apply_mapping broadcasts.
HOT_SHARE = 0.001


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank values with the number of rows that hold them: (dirty, n)."""
    value = F.col(column)
    return df.where(has_text(value)).groupBy(value.alias("dirty")).agg(F.count(F.lit(1)).alias("n"))


def values_of(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """The same for several columns out of one pass: each row is expanded once for each column, then added up.

    The values of all columns are staged together, in a folder for each column.
    """
    counts = df.select(*columns).groupingSets([[column] for column in columns], *columns)
    counts = counts.agg(F.count(F.lit(1)).alias("n"), *[F.grouping(c).alias(f"without_{i}") for i, c in enumerate(columns)])
    number, dirty = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, column in enumerate(columns):
        within = F.col(f"without_{i}") == 0
        number, dirty = F.when(within, F.lit(i)).otherwise(number), F.when(within, F.col(column)).otherwise(dirty)
    named = counts.select(dirty.alias("dirty"), "n", number.alias("number"))
    stored = stage(named.where(has_text(F.col("dirty"))), "values", "number")
    return {column: stored.where(F.col("number") == i).select("dirty", "n") for i, column in enumerate(columns)}


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    """The same in the order of the values, as a resolver is best asked: spellings of one name come together."""
    return distinct_values(df, column).orderBy("dirty")


def one_pair_each(mapping: DataFrame) -> DataFrame:
    """(dirty, clean) with one row per dirty value, the smallest clean one; null values are left out."""
    pairs = mapping.where(F.col("dirty").isNotNull() & F.col("clean").isNotNull())
    return pairs.groupBy("dirty").agg(F.min("clean").alias("clean"))


def apply_mapping(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    target: str,
    spread_by: str,
    counts: DataFrame | None = None,
    packed: bool = False,
) -> DataFrame:
    """Add ``target``: the mapped value of ``column``, or the value itself where it has no mapping.

    ``mapping`` is (dirty, clean); a value with several pairs gets the smallest
    one, so no row is ever doubled. The values that hold at least HOT_SHARE of
    the rows are looked up in a broadcast of at most 1 / HOT_SHARE rows. Rows
    settled there, and rows with nothing to look up, enter the second join
    spread out by ``spread_by`` (a column of many values, such as the row id; by
    the whole row where it is null). So no key of a shuffled join gathers a
    large share of the rows, whichever value is hot. ``counts`` is (dirty, n) as
    ``distinct_values`` gives it, for callers who have it already. ``packed``
    packs the texts of the rows for the second join: for callers who use all
    columns of the result, as one that is not used is moved then, too.
    """
    value = F.col(column)
    pairs = one_pair_each(mapping)
    counts = stage(distinct_values(df, column), "counts") if counts is None else counts.select("dirty", "n")
    total = counts.agg(F.sum("n")).scalar()
    hot = counts.where(F.col("n") >= total * HOT_SHARE).select("dirty").join(pairs, "dirty")
    spread = F.coalesce(F.col(spread_by).cast("string"), F.xxhash64(*df.columns).cast("string"))
    hot_value, hot_clean, is_open, key, other, other_clean = (
        unused_name(name, [*df.columns, target]) for name in ("hot", "hot_clean", "open", "key", "other", "other_clean")
    )
    looked_up = df.join(
        F.broadcast(hot.select(F.col("dirty").alias(hot_value), F.col("clean").alias(hot_clean))),
        value == F.col(hot_value),
        "left",
    ).drop(hot_value)
    opened = has_text(value) & F.col(hot_clean).isNull()
    keyed = looked_up.withColumns({is_open: opened, key: F.when(opened, value).otherwise(spread)})
    texts = [c for c in text_columns(df) if c != target] if packed else []
    if texts:
        box = unused_name("packed", [*keyed.columns, target])
        # an open value is its key already
        boxed = [F.when(~F.col(is_open), value) if c == column else F.col(c) for c in texts] + [F.col(hot_clean)]
        keyed = keyed.withColumn(box, pack(boxed)).drop(*texts, hot_clean)
    others = pairs.select(F.col("dirty").alias(other), F.col("clean").alias(other_clean))
    joined = keyed.join(others, (F.col(key) == F.col(other)) & F.col(is_open), "left")
    if texts:
        joined = unpack(joined, box, [*texts, hot_clean])
        whole = {c: F.when(F.col(is_open), F.col(key)).otherwise(value) if c == column else F.col(c) for c in texts}
        whole = {c: text if df.schema[c].nullable else F.coalesce(text, F.lit("")) for c, text in whole.items()}
        joined = joined.withColumns(whole).select(*df.columns, hot_clean, is_open, key, other, other_clean)
    found = F.coalesce(hot_clean, other_clean, value)
    return joined.withColumn(target, found).drop(hot_clean, is_open, key, other, other_clean)


def only_new(values: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of ``values`` whose ``dirty`` has no mapping yet."""
    return values.join(mapping.select("dirty"), "dirty", "left_anti")


def unmapped_values(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Distinct non-blank values of a column that the mapping does not cover: (dirty, n)."""
    return only_new(distinct_values(df, column), mapping)


def merge_mapping(stored: DataFrame, new: DataFrame) -> DataFrame:
    """All stored pairs plus the new ones for values not stored yet: one pair for each value, a stored one wins."""
    kept = one_pair_each(stored)
    return kept.unionByName(one_pair_each(only_new(new, kept)))


def out_of_vocabulary(df: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    """Distinct non-blank values outside a closed vocabulary: (dirty, n)."""
    return distinct_values(df.where(~F.col(column).isin(*vocabulary)), column)
