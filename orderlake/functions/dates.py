"""Mixed-format dates to timestamps without a time zone.

Each accepted shape is a pattern, and where needed the ISO text it is rewritten
to. A row is tested against the patterns in order and cast once, so no parser
runs on text it cannot read, and the cast does not depend on the session's
time zone; digits beyond microseconds are cut. Text that fits no shape, or names a day that does not exist, is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orderlake.functions.text import strip

# English month names.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]

_TIME = r"\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?"
_MONTH_NUMBER = r"0?[1-9]|1[0-2]"
_MONTH_NAME = "|".join(f"{m}|{m[:3]}" for m in MONTHS)

# The formats the sources use: ISO with or without a time, numbers with slashes
# in the order of the policy, and a short month name, which Spark's formatter reads.
_ISO = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}(?:[ T]{_TIME})?$"
_DAY_FIRST = (rf"^(\d{{1,2}})/({_MONTH_NUMBER})/(\d{{4}})$", "$3-$2-$1")
_MONTH_FIRST = (rf"^({_MONTH_NUMBER})/(\d{{1,2}})/(\d{{4}})$", "$3-$1-$2")
_SHORT_NAME = r"^[A-Za-z]{3} \d{1,2}, \d{4}$"

# Formats only guessed at. Numbers are month first, and day first where the month
# would be above 12; then year first, with slashes or nothing in between. Groups
# of the alternatives that do not fit are empty in the rewritten text.
_DAY, _YEAR = r"\d{1,2}", r"\d{4}"
_TO_ISO = (
    rf"^(?:({_MONTH_NUMBER})([/-])({_DAY})\2({_YEAR})|({_DAY})([/-])({_MONTH_NUMBER})\6({_YEAR})"
    rf"|({_YEAR})/({_DAY})/({_DAY})|({_YEAR})(\d\d)(\d\d))((?: {_TIME})?)$",
    "$4$8$9$12-$1$7$10$13-$3$5$11$14$15",
)
# Any month name before or after the day; the look-ahead checks the whole name.
_NAME = rf"(?=(?:{_MONTH_NAME})\b)([a-z]{{3}})[a-z]*"
_TO_SHORT_NAME = (
    rf"(?i)^(?:{_NAME} ({_DAY}),? |({_DAY})[ -]{_NAME}[ -])({_YEAR})$",
    "$1$4 $2$3, $5",
)


def _iso(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def _short_name(text: Column) -> Column:
    return F.try_to_date(text, "MMM d, yyyy").cast("timestamp_ntz")


def _only(text: Column, pattern: str) -> Column:
    """The text if it fits, else an empty one, which is no date."""
    return F.regexp_extract(text, pattern, 0)


def _guessed(text: Column) -> Column:
    """One rewriting per kind of format, so that the generated code stays small
    enough for the JVM to compile."""
    spaced = F.regexp_replace(text, r"\s+", " ")
    return F.coalesce(
        _iso(_only(F.regexp_replace(spaced, *_TO_ISO), _ISO)),
        _short_name(_only(F.regexp_replace(spaced, *_TO_SHORT_NAME), _SHORT_NAME)),
    )


def parse_date(c: Column, month_first: bool = False) -> Column:
    """Read a date in any accepted shape.

    ``11/07/2024`` is 11 July, or 7 November with ``month_first``. Other
    numeric shapes are month first either way.
    """
    text = strip(c)
    slashes = _MONTH_FIRST if month_first else _DAY_FIRST
    return (
        F.when(text.rlike(_ISO), _iso(text))
        .when(text.rlike(slashes[0]), _iso(F.regexp_replace(text, *slashes)))
        .when(text.rlike(_SHORT_NAME), _short_name(text))
        .otherwise(_guessed(text))
    )


def month_name(ts: Column) -> Column:
    """Full English month name."""
    return F.date_format(F.to_date(ts), "MMMM")


def month_period(ts: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(F.to_date(ts), "yyyy-MM")
