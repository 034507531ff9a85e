"""Date expressions: mixed-format parsing, week labels, dates inside file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearbook.functions.text import literal_table, strip

# The forms of a date. Each bracket is an optional section, so one
# pass of one formatter tries them in turn, without an error raised per miss.
DATE_FORMS = (
    "[yyyy-M-d['T'HH:mm[:ss[.SSSSSS]]['Z']][ HH:mm[:ss[.SSSSSS]]]]"
    "[M/d/yyyy][yyyy/M/d]"
    "[MMM d, yyyy][MMMM d, yyyy][MMM d yyyy][MMMM d yyyy]"
    "[d-MMM-yyyy][d MMM yyyy][d MMMM yyyy]"
    "[yyyyMMdd]"
)

# The shape of a text that can be one of these forms, and not two of them in a row.
ONE_DATE = (
    r"^(\d{4}-\d{1,2}-\d{1,2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?Z?)?"
    r"|\d{1,2}/\d{1,2}/\d{4}|\d{4}/\d{1,2}/\d{1,2}"
    r"|[A-Za-z]{3,9}\.? \d{1,2},? \d{4}|\d{1,2}[- ][A-Za-z]{3,9}[- ]\d{4}|\d{8})$"
)

# Rewrites for dates of three numbers, to month/day/year with four-digit years:
# 69..99 are 19xx, 00..68 are 20xx, and no month is above 12. With full stops the
# day comes first, as in the countries that write them.
SLASHES = [
    (r"^(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2})$", "$2/$1/$3"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4}|\d{2})$", "$1/$2/$3"),
    (r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)$", "$119$2"),
    (r"^(\d{1,2}/\d{1,2}/)(\d{2})$", "$120$2"),
    (r"^(1[3-9]|[2-9]\d)/(\d{1,2})/(\d{4})$", "$2/$1/$3"),
]

# The names of months that DATE_FORMS knows, the short ones and the long ones.
_LONG_MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
MONTHS = {name: str(i) for i, long in enumerate(_LONG_MONTHS, 1) for name in (long[:3], long)}

# The most frequent forms: the cast reads them, once their parts are in order, many times faster than a formatter.
ISO = r"^\d{4}-\d{2}-\d{2}$"
THREE_NUMBERS = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})$"
NAMED_MONTH = r"^([A-Za-z]{3,9} \d{1,2},? \d{4}|\d{1,2}-[A-Za-z]{3}-\d{4}|\d{1,2} [A-Za-z]{3,9} \d{4})$"


def _by_numbers(text: Column) -> Column:
    """The date of THREE_NUMBERS: the month is first but with full stops; a month above 12 is the day."""
    first = F.regexp_replace(text, THREE_NUMBERS, "$4-$1-$3").try_cast("date")
    last = F.regexp_replace(text, THREE_NUMBERS, "$4-$3-$1").try_cast("date")
    return F.when(text.contains("."), F.coalesce(last, first)).otherwise(F.coalesce(first, last))


def _by_name(text: Column) -> Column:
    """The date of NAMED_MONTH; null for a name that is no month's."""
    parts = F.split(F.lower(text), "[ ,-]+")
    day_first = F.substring(text, 1, 1) <= "9"
    day, name = F.when(day_first, parts[0]).otherwise(parts[1]), F.when(day_first, parts[1]).otherwise(parts[0])
    month = F.try_element_at(literal_table(MONTHS), name)
    return F.concat(parts[2], F.lit("-"), month, F.lit("-"), day).try_cast("date")


def parse_date(value: Column) -> Column:
    """Text in any of the known formats -> date; everything else -> null.

    ``a/b/yyyy`` and ``a-b-yyyy`` are read month-first, and day-first only where
    a month cannot be above 12; ``a.b.yyyy`` is day-first.
    """
    text = strip(value)
    return (
        F.when(text.rlike(ISO), text.try_cast("date"))
        .when(text.rlike(THREE_NUMBERS), _by_numbers(text))
        .when(text.rlike(NAMED_MONTH), _by_name(text))
        .otherwise(_by_formatter(text))
    )


def _by_formatter(text: Column) -> Column:
    """The date in any of the known formats, which are tried one after the other."""
    numbers = text
    for form, ordered in SLASHES:
        numbers = F.regexp_replace(numbers, form, ordered)
    ordered = F.when(text.rlike(r"^\d{1,2}[-./]"), numbers).otherwise(text)
    return F.try_to_date(F.when(ordered.rlike(ONE_DATE), ordered), DATE_FORMS)


def is_ambiguous_date(value: Column) -> Column:
    """True where month-first and day-first reading both work and differ."""
    text = strip(value)
    either_way = text.rlike(r"^(0?[1-9]|1[0-2])([/-])(0?[1-9]|1[0-2])\2(\d{4}|\d{2})$")
    the_same = text.rlike(r"^0?(\d{1,2})[/-]0?\1[/-]")
    return F.coalesce(either_way & ~the_same, F.lit(False))


def week_ending(day: Column) -> Column:
    """The Sunday that closes the Monday-to-Sunday week of a day."""
    return F.next_day(F.date_sub(day, 1), "SUN")


def date_in_name(name: Column) -> Column:
    """First ``YYYY-MM-DD`` inside a file name as text, or null."""
    return F.nullif(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def report_year(name: Column) -> Column:
    """Year of the date inside a file name; the current year where there is none."""
    return F.coalesce(F.left(date_in_name(name), F.lit(4)).cast("int"), F.year(F.current_date()))
