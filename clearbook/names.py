"""Column names that clash with no others."""

from __future__ import annotations

from collections.abc import Iterable


def unused_name(wanted: str, taken: Iterable[str]) -> str:
    """A column name that none of ``taken`` clashes with, upper and lower case alike."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted
