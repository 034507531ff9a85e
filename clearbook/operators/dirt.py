"""Input for the cleaning queries: given values written the way people write them.

Every function takes the clean value and a whole-number selector, so the same
row always gets the same text. The rules are about form alone (case, blanks,
marks, one lost letter, date order, currency signs); the values are those of
the tables.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearbook.functions.text import grouped_number
from clearbook.functions.vocabulary import REGION_SPELLINGS, SEGMENT_SPELLINGS


def selector(bound: int, *terms: tuple[str, int]) -> Column:
    """A number in 0..bound-1 from whole-number columns: the weighted sum modulo the bound."""
    return reduce(lambda a, b: a + b, (F.col(name) * weight for name, weight in terms)) % bound


def written_name(name: Column, percent: Column, position: Column) -> Column:
    """Mostly the name itself; else in one case, with blanks, with other marks, or without the letter at ``position``."""
    lost = F.concat(F.left(name, position - 1), F.substr(name, position + 1))
    return (
        F.when(percent >= 97, lost)
        .when(percent >= 93, F.replace(name, F.lit("#"), F.lit(" - ")))
        .when(percent >= 88, F.concat(F.lit("  "), F.replace(name, F.lit("#"), F.lit("  #")), F.lit("\t")))
        .when(percent >= 80, F.lower(name))
        .when(percent >= 70, F.upper(name))
        .otherwise(name)
    )


def _spelling(value: Column, spellings: Mapping[str, Sequence[str]], pick: Column) -> Column:
    table = F.from_json(F.lit(json.dumps(spellings)), "map<string, array<string>>")
    known = F.try_element_at(table, value)
    return F.try_element_at(known, (pick % F.size(known) + 1).cast("int"))


def written_region(region: Column, pick: Column) -> Column:
    return _spelling(region, REGION_SPELLINGS, pick)


def written_segment(segment: Column, pick: Column) -> Column:
    return _spelling(segment, SEGMENT_SPELLINGS, pick)


def written_date(day: Column, pick: Column) -> Column:
    """ISO, with slashes either way round, with full stops, or with the month's name, by ``pick`` in 0..5."""
    patterns = ["yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "dd.MM.yyyy", "d-MMM-yyyy", "MMMM d, yyyy"]
    texts = [F.when(pick == i, F.date_format(day, pattern)) for i, pattern in enumerate(patterns)]
    return F.coalesce(*texts)


def written_amount(amount: Column, permille: Column) -> Column:
    """A plain number, a dollar text, a refund, nothing, or what is no number; ``permille`` is in 0..999."""
    money = amount.cast("decimal(18,2)").cast("string")
    odd = F.array(*map(F.lit, ["1e20", "5e400", "NaN", "Infinity", "-Infinity", "unknown"]))
    return (
        F.when(permille < 6, F.get(odd, permille.cast("int")))
        .when(permille < 40, F.lit(None).cast("string"))
        .when(permille < 55, F.concat(F.lit("-"), money))
        .when(permille < 100, F.concat(F.lit("$ "), grouped_number(amount, 2)))
        .otherwise(money)
    )


def written_note(text: Column, pick: Column) -> Column:
    return F.when(pick % 7 == 0, F.lit("")).when(pick % 7 != 1, text)
