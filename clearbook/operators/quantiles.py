"""Quantiles of amounts out of mergeable sketches, for inputs too large to sort.

A sketch of a group's amounts is a partial like a sum: sketches of days unite to
those of months, and of regions to that of all. With SIZE entries kept a level
the rank of a quantile is wrong by less than RANK_ERROR of all rows, with 99 %
confidence, however many rows there are. Exact medians stay with ``F.median``,
which keeps all values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 800
RANK_ERROR = 0.0045

SKETCH, ROWS = "amounts", "priced_rows"


def amount_sketches(rows: DataFrame, keys: Sequence[str], amount: Column, size: int = SIZE) -> DataFrame:
    """(keys, amounts, priced_rows): a sketch of the amounts of each group; null amounts are left out."""
    priced = rows.select(*keys, amount.cast("double").alias("amount")).where("amount IS NOT NULL")
    return priced.groupBy(*keys).agg(
        F.kll_sketch_agg_double("amount", size).alias(SKETCH), F.count("amount").alias(ROWS)
    )


def unite(sketches: DataFrame, *keys: str) -> DataFrame:
    """The sketches at a coarser grain."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH), F.sum(ROWS).alias(ROWS))


def quantiles(sketches: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Add ``quantiles``: for each share the amount that about this share of the rows does not exceed."""
    found = F.array(*[F.kll_sketch_get_quantile_double(SKETCH, F.lit(share)) for share in shares])
    return sketches.withColumn("quantiles", found).drop(SKETCH)
