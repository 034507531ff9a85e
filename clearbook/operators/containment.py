"""Closed matching against a vocabulary table: the first entry that contains a text, or is contained in it.

Nothing is compared with everything. A text that contains another has all its
grams (substrings of one length), so one of them is enough to find it: the
shorter side is represented by a single gram, its anchor, and the longer side by
all of its grams. The anchor is the gram that fewest of the longer side have; if
none has it, there is no match. Shorter texts than a gram are their own anchor,
and the longer side then shows its substrings of that length too. Both
directions are such a join, and every candidate is verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import has_text
from clearbook.sources.staging import stage

GRAM = 6


def _substrings(text: Column, size: int) -> Column:
    """The distinct substrings of ``size`` characters; none of a shorter text."""
    count = F.length(text) - size + 1
    places = F.sequence(F.lit(1), F.greatest(count, F.lit(1)))
    cut = F.array_distinct(F.transform(places, lambda place: F.substring(text, place, F.lit(size))))
    return F.when(count > 0, cut).otherwise(F.array().cast("array<string>"))


def _pairs(short: DataFrame, long: DataFrame, gram: int) -> DataFrame:
    """(inner, outer): the texts of ``short`` that stand within texts of ``long``; both are (folded), distinct."""
    folded = F.col("folded")
    sizes = short.where(F.length(folded) < gram).select(F.length(folded).alias("size")).distinct().collect()
    shown = [_substrings(folded, size) for size in [*sorted(row.size for row in sizes), gram]]  # at most ``gram`` sizes
    grams = long.select(folded.alias("outer"), F.explode(F.concat(*shown)).alias("gram"))
    frequent = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.length(folded) < gram, F.array(folded)).otherwise(_substrings(folded, gram))
    # a gram that no text of the longer side has rules its owner out, so it counts as the rarest
    anchors = (
        short.select(folded.alias("inner"), F.explode(own).alias("gram"))
        .join(frequent, "gram", "left")
        .groupBy("inner")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("anchor"))
        .where("anchor.n > 0")
        .select("inner", F.col("anchor.gram").alias("gram"))
    )
    return anchors.join(grams, "gram").where(F.col("outer").contains(F.col("inner"))).select("inner", "outer")


def first_containing(values: DataFrame, vocabulary: DataFrame, gram: int = GRAM) -> DataFrame:
    """(dirty, entry, ordinal): the entry of the smallest ordinal that contains a value or is contained in it.

    ``values`` has a column ``dirty`` and ``vocabulary`` is (ordinal, entry), of
    any size. Case does not matter. Values without a match have null; null and
    blank values, and empty entries, match nothing. Each distinct value is one
    row; of entries with one ordinal the smallest counts.
    """
    texts = values.where(F.col("dirty").isNotNull()).select("dirty").distinct()
    texts = stage(texts.select("dirty", F.when(has_text(F.col("dirty")), F.lower("dirty")).alias("folded")), "texts")
    entries = vocabulary.where(F.length("entry") > 0).groupBy(F.lower("entry").alias("folded"))
    entries = stage(entries.agg(F.min(F.struct("ordinal", "entry")).alias("first")), "entries")
    folded = texts.where(F.col("folded").isNotNull()).select("folded").distinct()
    inside = _pairs(entries.select("folded"), folded, gram).select(F.col("inner").alias("found"), F.col("outer").alias("folded"))
    around = _pairs(folded, entries.select("folded"), gram).select(F.col("outer").alias("found"), F.col("inner").alias("folded"))
    numbered = inside.unionByName(around).join(entries.withColumnRenamed("folded", "found"), "found")
    best = numbered.groupBy("folded").agg(F.min("first").alias("first"))
    return texts.join(best, "folded", "left").select("dirty", "first.entry", "first.ordinal")


def match_vocabulary(values: DataFrame, vocabulary: DataFrame, gram: int = GRAM) -> DataFrame:
    """(dirty, clean): the containment match, else the first entry of the vocabulary as the last resort.

    Blank values are not matched and stay as they are; an empty vocabulary gives
    null.
    """
    last_resort = vocabulary.where(F.length("entry") > 0).agg(F.min(F.struct("ordinal", "entry"))["entry"]).scalar()
    found = first_containing(values, vocabulary, gram)
    clean = F.when(has_text(F.col("dirty")), F.coalesce("entry", last_resort)).otherwise(F.col("dirty"))
    return found.select("dirty", clean.alias("clean"))


def outside_vocabulary(values: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(dirty): the distinct values that are no entry of a vocabulary table; blank ones are left out."""
    entries = vocabulary.select(F.col("entry").alias("dirty")).distinct()
    return values.where(has_text(F.col("dirty"))).select("dirty").distinct().join(entries, "dirty", "left_anti")
