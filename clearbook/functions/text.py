"""Text expressions: trimming, missing tokens, title case, name keys, display text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# The white space that trimming removes, non-breaking blanks and all others of Unicode included.
WHITE_SPACE = (
    " \t\n\r\f\v\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space (``trim`` alone only removes blanks)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(strip(text), rf"[{WHITE_SPACE}]+", " ")


def has_text(text: Column) -> Column:
    """True for values worth cleaning: neither null nor blank."""
    return F.coalesce(strip(text) != "", F.lit(False))


def missing_to_null(text: Column, tokens: Sequence[str]) -> Column:
    return F.when(~text.isin(*tokens), text)


def title_case(text: Column) -> Column:
    """Capitalise the first letter after every non-letter, lower-case the rest."""
    pieces = F.split(F.lower(strip(text)), r"(?<=[^\p{L}])")
    return F.array_join(F.transform(pieces, F.initcap), "")


def name_key(name: Column) -> Column:
    """Comparison key of a company name.

    Folds case, the and/& swap and the long forms of Corp, Inc and Co, then
    keeps letters and digits only. ``company`` is folded inside words too,
    because dirty data holds forms such as ``Companyrp``. A name without any
    letter or digit is its own key.
    """
    key = F.regexp_replace(F.lower(name), r"\band\b", "")
    for long_form, short_form in (("corporation", "corp"), ("incorporated", "inc"), ("company", "co")):
        key = F.replace(key, F.lit(long_form), F.lit(short_form))
    key = F.regexp_replace(key, r"[^\p{L}\p{N}]", "")
    return F.when(key == "", strip(name)).otherwise(key)


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def literal_table(pairs: Mapping[str, str]) -> Column:
    """A fixed text-to-text table as one constant, folded when the query is planned."""
    return F.str_to_map(F.lit("\n".join(f"{key}\t{value}" for key, value in pairs.items())), F.lit("\n"), F.lit("\t"))


def first_containing(text: Column, vocabulary: Sequence[str]) -> Column:
    """First vocabulary entry that contains, or is contained in, the lower-cased text."""
    folded = F.lower(text)
    entries = F.split(F.lit("\n".join(vocabulary)), "\n")
    hits = F.filter(entries, lambda entry: folded.contains(F.lower(entry)) | F.lower(entry).contains(folded))
    return F.get(hits, F.lit(0))


def fallback_match(text: Column, vocabulary: Sequence[str]) -> Column:
    """Containment match, else the first vocabulary entry as the last resort."""
    return F.when(text.isNotNull(), F.coalesce(first_containing(text, vocabulary), F.lit(vocabulary[0])))


def grouped_number(value: Column, digits: int = 0) -> Column:
    """``1234567.5`` -> ``1,234,568``; halves go to the even neighbour."""
    return F.format_number(value, digits)


def shorten(text: Column, length: int = 200) -> Column:
    return F.left(text, F.lit(length))


def display_label(column_name: str) -> str:
    """``industry_segment_clean`` -> ``Industry Segment`` (a heading, driver side)."""
    return " ".join(word.capitalize() for word in column_name.removesuffix("_clean").split("_"))
