"""Text standardization as code-generated Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from orderlake.contracts import BLANK_EMAILS, PLACEHOLDER_EMAIL

# The characters that count as white space at the ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A Unicode noncharacter plus a space: a word break that no real text holds.
_BREAK = "\ufdd0 "
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{Lt}"


def strip(c: Column) -> Column:
    """Drop white space of any kind at both ends (plain ``trim`` drops spaces only)."""
    return F.trim(c, F.lit(WHITESPACE))


def title(c: Column) -> Column:
    """Capital after every character that has no case: ``o'neil`` -> ``O'Neil``.

    ``initcap`` starts words at spaces only, so a removable break is put before
    each cased character that follows an uncased one.
    """
    broken = F.regexp_replace(c, f"([^{_CASED} ])([{_CASED}])", f"$1{_BREAK}$2")
    return F.replace(F.initcap(broken), F.lit(_BREAK), F.lit(""))


def clean_lower(c: Column) -> Column:
    return F.lower(strip(c))


def clean_title(c: Column) -> Column:
    return title(strip(c))


def snake(c: Column) -> Column:
    """Lower-cased, with each inner space as an underscore."""
    return F.replace(clean_lower(c), F.lit(" "), F.lit("_"))


def clean_email(c: Column) -> Column:
    """Strip and lower; texts that only say "missing" become NULL."""
    email = clean_lower(c)
    return F.when(~email.isin(BLANK_EMAILS), email)


def fill_email(c: Column) -> Column:
    return F.coalesce(c, F.lit(PLACEHOLDER_EMAIL))
