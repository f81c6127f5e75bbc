"""Column functions: built-in Spark expressions only."""

from orderlayers.functions.cleaning import (
    clean_amount,
    clean_date,
    clean_email,
    clean_phone,
    clean_text,
)
from orderlayers.functions.keys import quarantine_key, validated_key
from orderlayers.functions.money import items_total, standard_currency
from orderlayers.functions.predicates import (
    is_accepted,
    is_blank,
    is_quarantined,
    opens_like_json,
)

__all__ = [
    "clean_amount", "clean_date", "clean_email", "clean_phone", "clean_text",
    "is_accepted", "is_blank", "is_quarantined", "items_total", "opens_like_json",
    "quarantine_key", "standard_currency", "validated_key",
]
