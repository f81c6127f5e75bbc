"""Repairs of single fields. Patterns are Java regexes, so classes are ASCII only."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Eastern Arabic digits and decimal separator, and their ASCII forms.
ARABIC_NUMERALS = "٠١٢٣٤٥٦٧٨٩٫"
ASCII_NUMERALS = "0123456789."

# Patterns and output format.
NOT_NUMERIC = r"[^\d\.-]"
WHITESPACE_RUN = r"\s+"
AT_RUN = r"@+"
DOT_RUN = r"\.+"
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Texts that no replacement would change, or that cannot be dates.
ALL_NUMERIC = r"^[\d\.-]*\z"
ASCII_WHITESPACE = " \t\n\x0b\f\r"
STARTS_WITH_YEAR = r"^[\x00-\x20]*[+-]?\d{4}"

# Most fields are clean already. Each repair therefore looks first, with a test far
# cheaper than a replacement, and touches only text the replacement would change.


def _repaired(text: Column, damaged: Column, repaired: Column) -> Column:
    return F.when(damaged, repaired).otherwise(text)


def _holds_any(text: Column, parts: Iterable[str]) -> Column:
    return reduce(or_, [text.contains(part) for part in parts])


def clean_amount(amount: Column) -> Column:
    """Arabic numerals become ASCII; everything but digits, dots and minus goes."""
    repaired = F.regexp_replace(
        F.translate(amount, ARABIC_NUMERALS, ASCII_NUMERALS), NOT_NUMERIC, ""
    )
    return _repaired(amount, ~amount.rlike(ALL_NUMERIC), repaired)


def clean_phone(phone: Column) -> Column:
    """Whitespace inside the number goes."""
    repaired = F.regexp_replace(phone, WHITESPACE_RUN, "")
    return _repaired(phone, _holds_any(phone, ASCII_WHITESPACE), repaired)


def clean_email(email: Column) -> Column:
    """Doubled at-signs and dots shrink to one."""
    repaired = F.regexp_replace(F.regexp_replace(email, AT_RUN, "@"), DOT_RUN, ".")
    return _repaired(email, _holds_any(email, ("@@", "..")), repaired)


def clean_text(text: Column) -> Column:
    return F.trim(text)


def clean_date(date: Column) -> Column:
    """One timestamp format; anything unreadable is NULL.

    ``try_to_timestamp`` never raises under ANSI mode. Demanding a year first keeps a
    bare time of day from silently becoming today's date.
    """
    readable = F.when(date.rlike(STARTS_WITH_YEAR), F.try_to_timestamp(date))
    return F.date_format(readable, DATE_FORMAT)
