"""Row tests shared by classification, validation and routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlayers import schema as S

# Fixed value: optional quotes or whitespace, then an opening bracket or brace.
JSON_OPENING = r'^["\s]*[\[\{]'


def is_blank(value: Column) -> Column:
    """NULL, or nothing left once spaces (and only spaces) are trimmed."""
    return value.isNull() | (F.trim(value) == "")


def opens_like_json(text: Column) -> Column:
    """Only the first significant character is looked at; nothing is parsed.

    The plain openings are tested first, so long texts seldom reach the regex.
    """
    return text.startswith("[") | text.startswith("{") | text.rlike(JSON_OPENING)


def is_accepted(status: Column) -> Column:
    return status.isin(*S.ACCEPTED_STATUSES)


def is_quarantined(status: Column) -> Column:
    return status.startswith(S.QUARANTINED)
