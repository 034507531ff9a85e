"""Row numbers over a whole table without gathering it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clearbook.names import unused_name
from clearbook.sources.staging import stage

# monotonically_increasing_id() counts the rows of a partition in the low bits and names the partition in the others
ROW_BITS = 33


def numbered(df: DataFrame, order: Sequence[Column | str], column: str = "number") -> DataFrame:
    """Add ``column``: 0, 1, 2, ... without gaps in the order of ``order``; equal rows in any order among themselves.

    Rows are dealt to ranges and sorted within each, staged with their place in
    the range, and moved by the total of the ranges before theirs. Only those
    totals, a row for each range, meet in one task. The result reads the staged
    rows, so the numbers stay the same however often it is computed.
    """
    part, before = unused_name("part", df.columns), unused_name("before", df.columns)
    ranged = df.drop(column).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ranged.withColumn(column, F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn(part, F.shiftrightunsigned(column, ROW_BITS))
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)  # as many rows as there are ranges
    offsets = placed.groupBy(part).agg(F.count(F.lit(1)).alias(before))
    offsets = offsets.select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    row = F.col(column).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), part).withColumn(column, row + F.col(before)).drop(part, before)
