"""Texts of a row packed into one column, for rows that a shuffle moves.

A row takes eight bytes and a rounded-up length for each of its texts, which
compress badly. Packed, they are one text with a mark between them: a row of ten
short texts is written in little more than half the bytes. The bytes come back
as they were, whatever they are: a row that holds one of the marks, or bytes that
are no characters, is moved as a list of its texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from clearbook.names import unused_name

BETWEEN, NOTHING = "\u001f", "\u001e"  # between two texts, and in the place of a null


def text_columns(df: DataFrame) -> list[str]:
    """The columns that can be packed: strings without a collation or a length."""
    return [field.name for field in df.schema if field.dataType == StringType()]


def pack(texts: Sequence[Column]) -> Column:
    """One column that holds all the texts, nulls as well."""
    listed = F.array(*texts)
    marked = F.array_join(listed, "").rlike(f"[{BETWEEN}{NOTHING}\ufffd]")  # the last one stands for bad bytes
    return F.struct(
        F.when(~marked, F.array_join(listed, BETWEEN, NOTHING)).alias("joined"), F.when(marked, listed).alias("listed")
    )


def unpack(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Replace a packed ``column`` by its texts under their ``names``, in the order they were packed in."""
    parts = unused_name("parts", [*df.columns, *names])
    joined, listed = F.col(f"{column}.joined"), F.col(f"{column}.listed")
    df = df.withColumn(parts, F.split(joined, BETWEEN))
    texts = {}
    for i, name in enumerate(names):
        text = F.get(F.col(parts), F.lit(i))
        texts[name] = F.when(joined.isNull(), F.get(listed, F.lit(i))).when(text != NOTHING, text)
    return df.withColumns(texts).drop(column, parts)
