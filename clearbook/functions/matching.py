"""Matching free text to a closed vocabulary, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearbook.functions.text import first_containing, has_text, literal_table
from clearbook.functions.vocabulary import spelling_key


def _alias_lookup(text: Column, aliases: Mapping[str, str]) -> Column:
    return F.try_element_at(literal_table(aliases), F.regexp_replace(F.lower(text), "[^a-z0-9]", ""))


def _lookup(vocabulary: Sequence[str], aliases: Mapping[str, str]) -> dict[str, str]:
    """Every entry is an alias of itself."""
    return {**{spelling_key(entry): entry for entry in vocabulary}, **aliases}


def match_closed(text: Column, vocabulary: Sequence[str], aliases: Mapping[str, str]) -> Column:
    """Canonical entry for a text: by spelling, then by containment, else the first entry.

    Null and blank texts are not matched and stay as they are.
    """
    found = F.coalesce(
        _alias_lookup(text, _lookup(vocabulary, aliases)),
        first_containing(text, vocabulary),
        F.lit(vocabulary[0]),
    )
    return F.when(has_text(text), found).otherwise(text)


def match_method(text: Column, vocabulary: Sequence[str], aliases: Mapping[str, str]) -> Column:
    """How ``match_closed`` found its answer: exact, alias, contains, default; null if unmatched."""
    return F.when(
        has_text(text),
        F.when(text.isin(*vocabulary), "exact")
        .when(_alias_lookup(text, _lookup(vocabulary, aliases)).isNotNull(), "alias")
        .when(first_containing(text, vocabulary).isNotNull(), "contains")
        .otherwise("default"),
    )
