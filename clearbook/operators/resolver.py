"""External resolvers: numbered batches of dirty values in, answers out, defaults for the rest.

Values are numbered in their order over the whole table and cut into batches by
number, so n values make n / batch_size calls, rounded up, however they are
partitioned, and spellings that look alike meet in one call. A batch is a row. A
call that fails becomes a row with its error: it stops nothing else, and the
caller decides what becomes of the answers that did arrive (``sources.answers``
stores them, batch by batch).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import fallback_match, title_case
from clearbook.operators.numbering import numbered

BATCH_SIZE = 50

Resolver = Callable[[list[str]], dict[str, str]]

Finish = Callable[[DataFrame], DataFrame]


def batches_of(values: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """(batch, dirty_values): the distinct ``dirty`` values in order, ``batch_size`` to a batch, batches from 0 on.

    All batches but the last are full. Null values are in none.
    """
    distinct = values.where(F.col("dirty").isNotNull()).select("dirty").distinct()
    rows = numbered(distinct, ["dirty"])
    batch = F.floor(F.col("number") / batch_size).alias("batch")
    return rows.groupBy(batch).agg(F.sort_array(F.collect_list("dirty")).alias("dirty_values"))


def batch_sizes(batches: DataFrame) -> DataFrame:
    """(batch, size, first_value, last_value) of each call that would be made."""
    values = F.col("dirty_values")
    return batches.select(
        "batch",
        F.size(values).cast("long").alias("size"),
        F.element_at(values, 1).alias("first_value"),
        F.element_at(values, -1).alias("last_value"),
    )


def ask(batches: DataFrame, resolver: Resolver, attempts: int = 1) -> DataFrame:
    """(batch, dirty, answer, error, seconds): what ``resolver`` says to the values of each batch, one call for a batch.

    A value without an answer has null. A call that raises is made ``attempts``
    times in all; then its batch is one row with the error and no value.
    ``seconds`` is how long that took. Stage or store the result before using it
    twice, or the calls repeat.
    """

    def answer(frames):
        import pandas as pd

        for frame in frames:
            for batch, values in zip(frame["batch"], frame["dirty_values"], strict=True):
                dirty, error, mapping = [str(value) for value in values], None, {}
                begun = time.monotonic()
                for _ in range(attempts):
                    try:
                        mapping, error = resolver(dirty), None
                        break
                    except Exception as raised:
                        error = f"{type(raised).__name__}: {raised}"
                seconds = time.monotonic() - begun
                told = [None] if error else dirty
                yield pd.DataFrame(
                    {
                        "batch": [batch] * len(told),
                        "dirty": told,
                        "answer": [None] if error else [mapping.get(value) for value in dirty],
                        "error": [error] * len(told),
                        "seconds": [seconds] * len(told),
                    }
                )

    return batches.select("batch", "dirty_values").mapInPandas(
        answer, "batch long, dirty string, answer string, error string, seconds double"
    )


def open_answers(answered: DataFrame) -> DataFrame:
    """Answers for an open vocabulary: ``clean`` is the answer, else the value in title case."""
    return answered.withColumn("clean", F.coalesce("answer", title_case(F.col("dirty"))))


def closed_answers(answered: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """Answers for a closed vocabulary: one outside it, or none, is replaced by the containment match."""
    allowed = F.when(F.col("answer").isin(*vocabulary), F.col("answer"))
    return answered.withColumn("clean", F.coalesce(allowed, fallback_match(F.col("dirty"), vocabulary)))


def _all_or_error(answered: DataFrame) -> DataFrame:
    problem = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("The resolver failed: "), F.col("error"))))
    return answered.select("dirty", F.coalesce(problem.cast("string"), F.col("clean")).alias("clean"))


def resolve_batches(values: DataFrame, resolver: Resolver, batch_size: int = BATCH_SIZE) -> DataFrame:
    """(dirty, clean) for an open vocabulary: the resolver's answer, else the value in title case.

    For resolvers that cannot fail: a call that does stops the job, and nothing
    is kept. ``sources.answers.resolve_into`` keeps what was answered.
    """
    return _all_or_error(open_answers(ask(batches_of(values, batch_size), resolver)))


def resolve_closed(
    values: DataFrame, resolver: Resolver, vocabulary: Sequence[str], batch_size: int = BATCH_SIZE
) -> DataFrame:
    """The same for a closed vocabulary; an answer outside it, or none, is replaced by the containment match."""
    return _all_or_error(closed_answers(ask(batches_of(values, batch_size), resolver), vocabulary))


def parse_answer(answer: Column) -> Column:
    """``{"mapping": {dirty: clean}}`` as a map; null where the text is not such a document."""
    return F.from_json(answer, "mapping map<string, string>")["mapping"]


def answers_for(batches: DataFrame, dirty: str, answer: str) -> DataFrame:
    """The clean form of ``dirty`` out of the JSON ``answer`` next to it, title case where it has none."""
    found = F.try_element_at(parse_answer(F.col(answer)), F.col(dirty))
    return batches.select(
        F.col(dirty).alias("dirty"),
        F.coalesce(found, title_case(F.col(dirty))).alias("clean"),
        found.isNotNull().alias("answered"),
    )


def mapping_rows(batches: DataFrame, answer: str) -> DataFrame:
    """All (dirty, clean) pairs of a column of JSON answers; a bad or empty answer gives one null row."""
    return batches.select(F.explode_outer(parse_answer(F.col(answer))).alias("dirty", "clean"))
