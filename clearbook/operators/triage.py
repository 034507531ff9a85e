"""Triage of delivery errors by key words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbook.functions.text import shorten

# Key words per cause, tried in this order.
CAUSES = [
    ("authentication", ["unauthorized", "401"], "Authentication failed: check the client id and secret."),
    ("permission", ["forbidden", "403"], "Signed in, but the permission to write is missing."),
    ("site", ["not found", "404"], "The site or document library does not exist: check the address."),
    ("network", ["name resolution", "failed to resolve"], "Network or DNS issue: is the address reachable?"),
]
OTHER = ("other", "See the message and check the delivery settings.")


def _first_cause(message: Column, position: int, otherwise: str) -> Column:
    lowered = F.lower(message)
    answers = []
    for cause in CAUSES:
        hit = F.lit(False)
        for word in cause[1]:
            hit = hit | lowered.contains(word)
        answers.append(F.when(hit, cause[position]))
    return F.coalesce(*answers, F.lit(otherwise))


def triage(errors: DataFrame, message: str) -> DataFrame:
    """Add cause, hint and the first 200 characters of the message."""
    text = F.col(message)
    return errors.withColumns(
        {"cause": _first_cause(text, 0, OTHER[0]), "hint": _first_cause(text, 2, OTHER[1]), "reason": shorten(text)}
    )
