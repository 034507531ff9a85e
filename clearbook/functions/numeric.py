"""Rounding, money and percentage expressions (no UDFs, all codegen-able)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearbook.functions.text import WHITE_SPACE, strip

CENTS = "decimal(38,0)"

# What the cast would read beside plain numbers, as in "1d", "0x1p3", "nan" and "inf", or leave out at either end:
# letters, and control characters that are no white space. They are turned into what it reads nowhere.
NO_NUMBER = "".join(sorted({*"dfinpxDFINPX", *map(chr, range(0x20)), "\x7f"} - {*WHITE_SPACE}))

# Cents of amounts up to this are added up as longs, which hold those of some hundred million transactions of that
# size. Larger ones are added up as decimals of 38 digits, which hold a billion transactions of the largest size.
ORDINARY_AMOUNT = 1e9
LARGEST_AMOUNT = 1e25


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double the way numpy does: scale, round half to even, unscale."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def parse_money(text: Column) -> Column:
    """``"$1,234.50"`` -> 1234.5; anything that is not a plain finite number -> null.

    The text is named as few times as can be: a filter on the amount is moved
    to where the text is made, which is then made anew for each mention.
    """
    digits = strip(F.translate(text, f"{NO_NUMBER}$,", "_" * len(NO_NUMBER)))
    return finite(digits.try_cast("double"))


def finite(amount: Column) -> Column:
    """The number itself; null for NaN and the infinities."""
    return F.when(F.abs(amount) < F.lit(float("inf")), amount)


def is_countable(amount: Column) -> Column:
    """True for amounts that the analysis can add up: there, finite, and not beyond LARGEST_AMOUNT."""
    return F.coalesce(F.abs(amount) <= LARGEST_AMOUNT, F.lit(False))


def is_countable_gain(amount: Column) -> Column:
    """True for countable amounts that are not negative. The amount is named once, see ``parse_money``.

    There is one bucket, from 0 to LARGEST_AMOUNT; NaN is in none.
    """
    beyond = math.nextafter(LARGEST_AMOUNT, math.inf)
    return F.coalesce(F.width_bucket(amount, F.lit(0.0), F.lit(beyond), F.lit(1)) == 1, F.lit(False))


def to_cents(amount: Column) -> Column:
    """Whole cents as a long: sums are exact and independent of the partitioning. Null beyond ORDINARY_AMOUNT."""
    return F.when(F.abs(amount) <= ORDINARY_AMOUNT, F.rint(amount * 100).cast("long"))


def to_large_cents(amount: Column) -> Column:
    """Whole cents as a decimal for the countable amounts that ``to_cents`` leaves out; null for all others."""
    is_large = is_countable(amount) & (F.abs(amount) > ORDINARY_AMOUNT)
    return F.when(is_large, F.rint(amount * 100).cast(CENTS))


def cents_to_amount(cents: Column) -> Column:
    return cents.cast("double") / 100


def all_cents(cents: Column, large: Column) -> Column:
    """Cents of ordinary and of large amounts together, as a decimal, for sums that might leave a long."""
    return F.when(large.isNull(), cents.cast(CENTS)).otherwise(F.coalesce(cents, F.lit(0)).cast(CENTS) + large)


def percent_of(part: Column, whole: Column) -> Column:
    """Unrounded percentage; null where the whole is zero."""
    return F.try_divide(part, whole) * 100


def percent_change(current: Column, previous: Column) -> Column:
    """Change against the previous value in percent, 2 digits; null after zero."""
    return round_half_even((F.try_divide(current, previous) - 1) * 100, 2)
